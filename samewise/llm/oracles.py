"""SQL of the corpus queries, written anew from their contracts."""

from __future__ import annotations

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ESCAPED = r"regexp_replace({}, '<(\\*)\|', '<\1\\|', 'g')"
_ORDER = "ORDER BY turn NULLS FIRST, role, text"

#: CRC-32 of a UTF-8 text: the table follows from its polynomial.
_CRC_TABLE = """SELECT list(v ORDER BY i) AS crc FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS v FROM range(256) r(i))"""
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode({})), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda v, b: xor(v >> 8, crc[(xor(v, b) & 255) + 1])), 4294967295)"""


def _license_scan() -> str:
    """Places and spans by joins of three-word windows with the templates."""
    from .license_scan import MIN_COVER, SLACK, TEMPLATES

    rows = ", ".join(f"({i}, '{t.label}', string_split('{t.words}', ' '), {t.exact})" for i, t in enumerate(TEMPLATES))
    return f"""
        WITH t AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex({_LOWERED}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS words FROM documents),
        templates AS (SELECT * FROM (VALUES {rows}) v(no, label, words, exact)),
        k AS (SELECT no, label, exact, len(words) - 2 AS n, i AS place, words[i + 1] AS a, words[i + 2] AS b, words[i + 3] AS c FROM templates, unnest(range(len(words) - 2)) u(i)),
        g AS (SELECT rid, i AS pos, words[i + 1] AS a, words[i + 2] AS b, words[i + 3] AS c FROM t, unnest(range(greatest(len(words) - 2, 0))) u(i)),
        votes AS (SELECT DISTINCT rid, no, label, exact, n, place, pos - place AS diagonal FROM g JOIN k USING (a, b, c)),
        diagonals AS (SELECT rid, no, label, exact, n, diagonal, exact AND count(*) = n AS stands FROM votes GROUP BY rid, no, label, exact, n, diagonal),
        steps AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, no ORDER BY diagonal) <= {SLACK} THEN 0 ELSE 1 END AS step FROM diagonals),
        runs AS (SELECT *, sum(step) OVER (PARTITION BY rid, no ORDER BY diagonal) AS run FROM steps),
        covers AS (SELECT rid, no, run, count(DISTINCT place) AS held FROM runs JOIN votes USING (rid, no, diagonal) GROUP BY ALL),
        spans AS (SELECT rid, label, exact, any_value(held) / n AS cover, count(*) FILTER (stands) AS places,
            min(diagonal) FILTER (stands) AS low, max(diagonal) FILTER (stands) AS high FROM runs JOIN covers USING (rid, no, run) GROUP BY rid, no, label, exact, n, run),
        f AS (SELECT rid, sum(places) AS n_base, min(low) AS low, max(high) AS high, max(cover) AS score,
            list_sort(list(DISTINCT label) FILTER (places > 0)) AS base, list_sort(list(DISTINCT label) FILTER (places > 0 OR NOT exact AND cover >= {MIN_COVER})) AS every
            FROM spans GROUP BY rid)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(low AS BIGINT) AS first_word, CAST(high AS BIGINT) AS last_word,
            coalesce(array_to_string(base, ','), '') AS base_labels, coalesce(array_to_string(every, ','), '') AS labels, coalesce(score, 0.0) AS score
        FROM t LEFT JOIN f USING (rid)"""


def _url_rules() -> str:
    """Rules by counting every combination of tokens of every labelled page."""
    from .url_rules import MIN_CONFIDENCE, MIN_SUPPORT, RULES

    rules = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)
    subsets = "list_sort(list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1)) AS ts"
    masks = "unnest(range(1, CAST(1 AS BIGINT) << len(tokens))) u(mask)"
    return f"""
        WITH r AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        h AS (SELECT row_number() OVER () AS rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
        s AS (SELECT *, list_filter(string_split(host, '.'), lambda w: w <> '') AS names, list_filter(string_split(path, '/'), lambda w: w <> '') AS segments FROM h),
        t AS (SELECT rid, page_id, host, path, list_distinct(list_concat(list_transform(names, lambda w, i: 'host:' || array_to_string(names[i:], '.')),
            list_transform(segments, lambda w: 'path:' || regexp_replace(w, '[0-9]+', '0', 'g')))) AS tokens FROM s),
        known AS (SELECT tokens, CASE WHEN toxic = 1 OR quality = 0 THEN 'block' ELSE 'allow' END AS verdict FROM t JOIN labels l ON l.doc_id = t.page_id),
        held AS (SELECT verdict, {subsets} FROM known, {masks}),
        whole AS (SELECT count(*) AS n FROM known),
        mined AS (SELECT ts, verdict, c, c / sum(c) OVER (PARTITION BY ts) AS confidence, c / n AS support FROM (SELECT ts, verdict, count(*) AS c FROM held GROUP BY ts, verdict), whole),
        kept AS (SELECT mined.* FROM mined, whole WHERE c >= ceil({MIN_SUPPORT} * n) AND confidence >= {MIN_CONFIDENCE}),
        own AS (SELECT rid, {subsets} FROM t, {masks}),
        best AS (SELECT rid, max((confidence, support, verdict))[3] AS verdict FROM own JOIN kept USING (ts) GROUP BY rid),
        rules AS (SELECT * FROM (VALUES {rules}) v(verdict, host, path)),
        named AS (SELECT rid, arg_max(x.host || x.path, length(x.host || x.path)) AS rule, arg_max(x.verdict, length(x.host || x.path)) AS verdict
            FROM t JOIN rules x ON (t.host = x.host OR ends_with(t.host, '.' || x.host)) AND starts_with(t.path, x.path) GROUP BY rid)
        SELECT page_id, host, path, rule, coalesce(named.verdict, best.verdict, 'allow') AS verdict FROM t LEFT JOIN named USING (rid) LEFT JOIN best USING (rid)"""


def _lm() -> str:
    """Counts of words and word pairs by grouping, scores by the formula of the smoothed pairs."""
    from .lm import ADDED, STRENGTH

    return f"""
        WITH crc_table AS ({_CRC_TABLE}),
        t AS (SELECT row_number() OVER () AS rid, doc_id, {_CRC.format("coalesce(CAST(doc_id AS VARCHAR), '')")} % 10 = 0 AS held_out,
            list_append(list_filter(string_split_regex({_LOWERED}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''), NULL) AS words FROM documents, crc_table),
        -- the end token is the null word; so is the begin mark, told apart by its place
        k AS (SELECT rid, held_out, unnest(words) AS w, unnest(range(len(words))) AS i, unnest(list_prepend(NULL, words[:-2])) AS h FROM t),
        one AS (SELECT w, count(*) AS c FROM k WHERE NOT held_out GROUP BY w),
        whole AS (SELECT sum(c) AS n, count(*) AS v, sum(c) + {ADDED} * (count(*) + 1) AS total FROM one),
        two AS (SELECT i = 0 AS opens, h, w, count(*) AS c FROM k WHERE NOT held_out GROUP BY ALL),
        past AS (SELECT opens, h, sum(c) AS c FROM two GROUP BY ALL),
        scored AS (SELECT rid, coalesce(one.c, 0) AS c1, (coalesce(one.c, 0) + {ADDED}) / total AS p1, (coalesce(two.c, 0) + {STRENGTH} * p1) / (coalesce(past.c, 0) + {STRENGTH}) AS p2
            FROM k CROSS JOIN whole LEFT JOIN one ON one.w IS NOT DISTINCT FROM k.w LEFT JOIN two ON two.opens = (k.i = 0) AND two.h IS NOT DISTINCT FROM k.h AND two.w IS NOT DISTINCT FROM k.w
            LEFT JOIN past ON past.opens = (k.i = 0) AND past.h IS NOT DISTINCT FROM k.h),
        s AS (SELECT rid, count(*) AS n_tokens, count(*) FILTER (c1 > 0) AS n_known, round(sum(log10(p1)), 6) AS base_score, round(sum(log10(p2)), 6) AS score FROM scored GROUP BY rid)
        SELECT doc_id, held_out, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(n_known AS BIGINT) AS n_known, CAST(coalesce(n, 0) AS BIGINT) AS train_tokens, base_score, score FROM t JOIN s USING (rid), whole"""


def _merkle() -> str:
    """Trees of all groups by one recursion upwards, proofs and folds by another one along the parents."""
    field = lambda c: f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c}, '-')"
    leaf = lambda text: "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"
    up = "SELECT {0}level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY pos)) FROM {1} WHERE n > 1 GROUP BY {0}level, pos // 8, n"
    runs = "SELECT {0}level, pos // 8 AS up, list(hash ORDER BY pos) AS run FROM {1} WHERE n > 1 GROUP BY {0}level, pos // 8"
    step = "level + 1 AS level, c.pos // 8 AS pos, (n + 7) // 8 AS n, sha256(array_to_string(run[1 : c.pos % 8] || [folded] || run[c.pos % 8 + 2 :], '')) AS folded, proof || array_to_string(run[1 : c.pos % 8] || run[c.pos % 8 + 2 :], '') AS proof"
    return f"""
        WITH RECURSIVE crc_table AS ({_CRC_TABLE}),
        d AS (SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN {_CRC.format('CAST(doc_id AS VARCHAR)')} % 3 = 0
            THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {leaf('text')} END AS shown FROM documents, crc_table),
        l AS (SELECT *, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d),
        tree(g, level, pos, n, hash) AS (SELECT g, 0, pos, n, leaf FROM l UNION ALL {up.format('g, ', 'tree')}),
        subroots AS (SELECT g, hash FROM tree WHERE n = 1),
        top(level, pos, n, hash) AS (SELECT 0, g, count(*) OVER (), hash FROM subroots UNION ALL {up.format('', 'top')}),
        runs AS ({runs.format('g, ', 'tree')}), top_runs AS ({runs.format('', 'top')}),
        climb(g, leaf_pos, level, pos, n, folded, proof) AS (SELECT g, pos, 0, pos, n, shown, '' FROM l
            UNION ALL SELECT c.g, leaf_pos, {step.replace('level + 1', 'c.level + 1')} FROM climb c JOIN runs r ON c.n > 1 AND r.g = c.g AND r.level = c.level AND r.up = c.pos // 8),
        ascend(g, leaf_pos, level, pos, n, folded, proof) AS (SELECT g, leaf_pos, 0, g, (SELECT count(*) FROM subroots), folded, proof FROM climb WHERE n = 1
            UNION ALL SELECT c.g, leaf_pos, {step.replace('level + 1', 'c.level + 1')} FROM ascend c JOIN top_runs r ON c.n > 1 AND r.level = c.level AND r.up = c.pos // 8),
        root AS (SELECT hash AS root FROM top WHERE n = 1)
        SELECT doc_id, leaf, s.hash AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
        FROM l JOIN subroots s USING (g) JOIN ascend a ON a.g = l.g AND a.leaf_pos = l.pos AND a.n = 1, root"""


ORACLES = {
    "op4_ngram_join": f"""
        WITH RECURSIVE t AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex({_LOWERED}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
        s AS (SELECT DISTINCT rid, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
            ELSE list_transform(range(len(words) - 3), lambda i: array_to_string(words[i + 1 : i + 4], ' ')) END) AS shingle FROM t),
        n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
        common AS (SELECT a.rid AS l, b.rid AS r, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.rid < b.rid GROUP BY ALL),
        links AS (SELECT l, r FROM common JOIN n x ON x.rid = l JOIN n y ON y.rid = r WHERE 100 * c >= 85 * (x.n + y.n - c)),
        linked AS (SELECT l AS a, r AS b FROM links UNION SELECT r, l FROM links),
        reach AS (SELECT a, b FROM linked UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a),
        lowest AS (SELECT a AS rid, min(doc_id) AS other FROM reach JOIN t ON t.rid = reach.b GROUP BY a)
        SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(t.doc_id, lowest.other) AS component_id
        FROM t LEFT JOIN n USING (rid) LEFT JOIN lowest USING (rid)""",
    "op6_url_rules": _url_rules(),
    "op7_license_scan": _license_scan(),
    "op1_chat_format": f"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
        s AS (SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id {_ORDER}), '') AS before FROM t)
        SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' {_ORDER})) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' {_ORDER}) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(12 + length({_ESCAPED.format("replace(replace(role, '%', '%25'), chr(10), '%0A')")}) + 1 + length({_ESCAPED.format('text')}) + 11) AS BIGINT) AS formatted_chars,
            CAST(sum(CASE WHEN (before, role) IN (('', 'system'), ('', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')) THEN 0 ELSE 1 END) AS BIGINT) AS n_violations
        FROM s GROUP BY conv_id""",
    "op9_shards": f"""
        WITH RECURSIVE crc_table AS ({_CRC_TABLE}),
        d AS (SELECT doc_id, CAST(octet_length(encode(text)) + 1 AS BIGINT) AS size, CAST({_CRC.format('text')} AS BIGINT) AS text_crc32,
                ('0x' || substr(md5(text), 1, 15))::BIGINT AS h
            FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents), crc_table),
        g AS (SELECT h, CAST(sum(size) AS BIGINT) AS bytes FROM d GROUP BY h),
        -- groups as large as the mean of what is left to fill take a shard of their own
        ranked AS (SELECT h, bytes, row_number() OVER (ORDER BY bytes DESC, h) AS r, sum(bytes) OVER () AS total,
                coalesce(sum(bytes) OVER (ORDER BY bytes DESC, h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g),
        alone AS (SELECT h, r - 1 AS shard FROM (SELECT *, bool_and(r <= 7 AND bytes * (9 - r) >= total - before) OVER (ORDER BY r) AS own FROM ranked) WHERE own),
        o AS (SELECT h, bytes, CAST(sum(bytes) OVER (ORDER BY h ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM g WHERE h NOT IN (SELECT h FROM alone)),
        whole AS (SELECT (SELECT count(*) FROM alone) AS n_alone, max(upto) AS total FROM o),
        -- the least capacity for which greedy filling needs no more shards than are left
        search AS (
            SELECT CAST(0 AS BIGINT) AS lo, total AS hi, 0 AS k, CAST(0 AS BIGINT) AS at FROM whole
            UNION ALL
            SELECT CASE WHEN NOT ends AND stuck THEN (lo + hi) // 2 + 1 ELSE lo END, CASE WHEN ends THEN (lo + hi) // 2 ELSE hi END,
                CASE WHEN ends OR stuck THEN 0 ELSE k + 1 END, CASE WHEN ends OR stuck THEN 0 ELSE "to" END
            FROM (SELECT s.*, coalesce(max(o.upto), 0) AS "to", coalesce(max(o.upto), 0) >= max(w.total) AS ends,
                    coalesce(max(o.upto), 0) <= s.at OR s.k + 1 >= 8 - max(w.n_alone) AS stuck
                FROM search s CROSS JOIN whole w LEFT JOIN o ON o.upto <= s.at + (s.lo + s.hi) // 2 WHERE s.lo < s.hi GROUP BY s.lo, s.hi, s.k, s.at)),
        best AS (SELECT min(hi) AS capacity FROM search WHERE lo >= hi),
        cuts AS (
            SELECT CAST(0 AS BIGINT) AS at
            UNION ALL
            SELECT max(o.upto) FROM cuts c CROSS JOIN best b JOIN o ON o.upto <= c.at + b.capacity AND o.upto > c.at GROUP BY c.at),
        placed AS (
            SELECT h, shard FROM alone
            UNION ALL
            SELECT o.h, (SELECT n_alone FROM whole) + count(c.at) FROM o LEFT JOIN cuts c ON c.at > 0 AND c.at < o.upto GROUP BY o.h)
        SELECT doc_id, size, text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard, CAST(NULL AS INTEGER) AS grown_shard,
            row_number() OVER (PARTITION BY shard ORDER BY h >> 52, ('0x' || substr(md5(CAST(coalesce(doc_id, 0) AS VARCHAR)), 1, 4))::INTEGER % 256, h, doc_id NULLS FIRST, text_crc32) - 1 AS slot
        FROM d JOIN placed USING (h)""",
    "op10_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWERED}) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, max(doc_id) AS keep_id, CAST(count(*) AS BIGINT) AS group_size FROM d GROUP BY text_sha256)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
        FROM d JOIN g USING (text_sha256)""",
    "op11_fim": """
        WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h FROM documents),
        u AS (SELECT rid, h, regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units FROM t),
        k AS (SELECT rid, h, len(units) AS n, unnest(units) AS unit, unnest(range(1, len(units) + 1)) AS i FROM u),
        c AS (SELECT rid, max(n) AS n, list_sort([('0x' || h[1:8])::BIGINT % (max(n) + 1), ('0x' || h[9:16])::BIGINT % (max(n) + 1)]) AS cut FROM k GROUP BY rid, h),
        p AS (SELECT rid, coalesce(string_agg(unit, '' ORDER BY i) FILTER (i <= cut[1]), '') AS a, coalesce(string_agg(unit, '' ORDER BY i) FILTER (i > cut[1] AND i <= cut[2]), '') AS b,
            coalesce(string_agg(unit, '' ORDER BY i) FILTER (i > cut[2]), '') AS c FROM k JOIN c USING (rid) GROUP BY rid),
        f AS (SELECT doc_id, text, a, b, p.c AS z, coalesce(c.n, 0) AS n,
            CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain' WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM t LEFT JOIN c USING (rid) LEFT JOIN p USING (rid))
        SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(a) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(b) AS BIGINT) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', a, '<S>', z, '<M>', b) ELSE concat('<S>', z, '<P>', a, '<M>', b) END) AS output_sha256, sha256(text) AS restored_sha256
        FROM f""",
    "op12_lm": _lm(),
    "op13_merkle": _merkle(),
}
