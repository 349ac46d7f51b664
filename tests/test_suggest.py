"""Kinds of columns suggested from content."""

from samewise.operators import suggest


def test_kinds(spark):
    rows = [(f"90012{i:04d}", f"Zelvora {i}", f"57 300 {i:07d}", f"a{i}@b.co", "Calle 1", "Cali", "4.5", "-74.1", "2024-01-05", "si" if i % 2 else "no", "a;b", f"{i}.5", 1234567 + i, "x" if i % 2 else "y", f"free{i}", None, i) for i in range(100)]
    names = ["NIT", "RAZON_SOCIAL", "TELEFONO", "contact", "DIRECCION", "CIUDAD", "LAT", "LON", "alta", "activo", "tags", "ventas", "codigo", "tipo", "nota", "vacia", "ID"]
    kinds = ", ".join(f"`{n}` {'long' if n in ('codigo', 'ID') else 'string'}" for n in names)
    got = {r["column"]: (r["decision"], r["kind"]) for r in suggest.suggest_schema(spark.createDataFrame(rows, kinds)).collect()}
    want = {"NIT": "identificador", "RAZON_SOCIAL": "nombre_empresa", "TELEFONO": "telefono", "contact": "email", "DIRECCION": "direccion", "CIUDAD": "ciudad", "LAT": "geo", "alta": "fecha", "activo": "booleano", "tags": "conjunto", "ventas": "numerico", "tipo": "categorico"}
    assert got == {n: ("incluida", want[n]) if n in want else ("omitida", "-") for n in names}
    reasons = {r["column"]: r["reason"] for r in suggest.suggest_schema(spark.createDataFrame(rows, kinds)).collect()}
    assert reasons["vacia"] == "columna vacía" and "DE FILA" in reasons["ID"] and "ambiguo" in reasons["codigo"] and "LON" in reasons["LAT"]
    assert all(r["decision"] == "omitida" for r in suggest.suggest_schema(spark.createDataFrame([], "NIT string, `a b` int")).collect())
