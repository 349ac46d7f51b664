"""A schema suggested from content: what each column of a table holds, and why."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text

#: What names of columns tell, and values that are yes or no (fixed values).
NAMED = {
    "identifier": r"NIT|TAX|RUT\b|RUC|CUIT|CEDULA|DOCUMENTO|DOC_?ID",
    "company": r"RAZON|COMPANY|EMPRESA|BUSINESS|SUPPLIER|PROVEEDOR|CLIENTE",
    "name": r"NOMBRE|NAME",
    "phone": r"TEL|PHONE|CEL|MOVIL|MOBILE",
    "email": r"MAIL|CORREO",
    "address": r"^DIR|ADDRESS|DOMICILIO",
    "city": r"CIUDAD|CITY|MUNICIPIO",
    "lat": r"^LAT(ITUD)?$|_LAT$",
    "lon": r"^LON(GITUD)?$|^LNG$|_LON$|_LNG$",
    "date": r"FECHA|DATE|^FEC_",
    "code": r"CIIU|^HS\b|SUBPARTIDA|PARTIDA|ARANCEL",
    "row": r"^(ID|INDEX|IDX|ROW_?ID|CONSECUTIVO)$",
}
YES_NO = ("SI", "SÍ", "S", "NO", "N", "TRUE", "FALSE", "T", "F", "V", "1", "0", "YES", "Y")


def profile(df: DataFrame) -> DataFrame:
    """One row per column with values: n, distinct (a sketch) and the shares of values by shape, from one aggregation over the whole table.

    Values are trimmed text; null and empty ones do not count; columns without values have no row.
    """
    wide = df.select(*[F.trim(F.col(f"`{c}`").cast("string")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    long = wide.unpivot([], wide.columns, "place", "v").filter("v <> ''")
    v, plain = F.col("v"), F.regexp_replace("v", r"[\s.\-]", "")
    digits = F.regexp_like(plain, F.lit(r"^\d+$"))
    share = lambda c, to: F.avg(F.coalesce(c, F.lit(False)).cast("double")).alias(to)
    found = long.groupBy("place").agg(
        F.count(F.lit(1)).alias("n"),
        F.approx_count_distinct("v", 0.01).alias("distinct"),
        share(digits, "digits"),
        F.coalesce(F.percentile_approx(F.when(digits, F.length(plain)), 0.5, 1000), F.lit(0)).alias("digit_length"),
        share(v.contains("@"), "at_sign"),
        share(text.normal_date(F.substring(v, 1, 10)).isNotNull() & F.regexp_like(v, F.lit(r"^\d{1,4}[-/]\d{1,2}[-/]\d{1,4}")), "dates"),
        share(F.replace(v, F.lit(","), F.lit(".")).try_cast("double").isNotNull(), "numbers"),
        share(F.regexp_like(v, F.lit(r"^-?\d+[.,]\d+$")), "decimals"),
        share(F.upper(v).isin(*YES_NO), "yes_no"),
        share(v.contains(";") | v.contains("|"), "several"),
        share(v.contains(" "), "spaces"),
    )
    names = F.element_at(F.array(*[F.lit(c) for c in df.columns]), F.substring("place", 2, 9).cast("int") + 1)
    return found.select(names.alias("column"), *found.columns[1:])


def suggest_schema(df: DataFrame) -> DataFrame:
    """(column, decision, kind, reason): incluida with the kind of field, or omitida; the first rule that holds decides."""
    named = lambda kind: F.regexp_like(F.col("column"), F.lit("(?i)" + NAMED[kind]))
    lats, lons = ([c for c in df.columns if re.search(NAMED[k], c, re.I)] for k in ("lat", "lon"))
    pairs = dict(zip(lats, lons))
    unique = F.col("distinct") / F.col("n")  # of a sketch, which errs by a few in a hundred
    said = lambda kind, reason: F.struct(F.lit("incluida").alias("decision"), F.lit(kind).alias("kind"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"))
    left_out = lambda reason: F.struct(F.lit("omitida").alias("decision"), F.lit("-").alias("kind"), F.lit(reason).alias("reason"))
    c, column = F.col, F.col("column")
    verdict = F.when(named("row") & (unique > 0.95), left_out("identificador DE FILA (único por registro), no de entidad"))
    for lat, lon in pairs.items():
        verdict = verdict.when(column == lat, said("geo", f"lat/lon emparejada con '{lon}'")).when(column == lon, left_out(f"longitud de '{lat}'"))
    verdict = (
        verdict.when(named("identifier") & (c("digits") >= 0.6) & (c("digit_length") >= 6), said("identificador", "nombre tipo NIT/TAX y contenido de dígitos largos"))
        .when(named("code"), said("jerarquico", "nombre tipo CIIU/HS/subpartida"))
        .when(named("phone") & (c("digits") >= 0.5), said("telefono", "nombre tipo teléfono y contenido numérico"))
        .when(named("email") | (c("at_sign") >= 0.5), said("email", "nombre tipo correo o '@' en la mayoría de valores"))
        .when(named("address"), said("direccion", "nombre tipo dirección"))
        .when(named("city"), said("ciudad", "nombre tipo ciudad/municipio"))
        .when(named("company") | (named("name") & (c("spaces") >= 0.3)), said("nombre_empresa", "nombre tipo razón social y texto multi-palabra"))
        .when((c("yes_no") >= 0.95) & (c("distinct") <= 4), said("booleano", "vocabulario sí/no/true/false"))
        .when(named("date") | (c("dates") >= 0.8), said("fecha", "nombre tipo fecha o >80% parsea como fecha"))
        .when(c("several") >= 0.3, said("conjunto", "múltiples valores por celda (';' o '|')"))
        .when((c("numbers") >= 0.9) & ((c("decimals") >= 0.3) | (c("digit_length") <= 5)), said("numerico", "contenido numérico continuo"))
        .when(c("numbers") >= 0.9, left_out("dígitos largos sin nombre de identificador: ambiguo, declárela a mano"))
        .when((unique <= 0.05) & (c("distinct") <= 100), said("categorico", F.concat(F.lit("baja cardinalidad ("), c("distinct").cast("string"), F.lit(" valores)"))))
        .otherwise(left_out("sin evidencia suficiente (texto libre o patrón no reconocido)"))
    )
    every = df.sparkSession.createDataFrame([(x,) for x in df.columns], "column string")
    judged = profile(df).select("column", verdict.alias("v"))
    return every.join(judged, "column", "left").select("column", *[F.coalesce(f"v.{f}", F.lit(d)).alias(f) for f, d in (("decision", "omitida"), ("kind", "-"), ("reason", "columna vacía"))])
