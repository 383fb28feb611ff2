"""The same results in plain SQL, for the queries that SQL can express."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"[^\x20\x09-\x0D]+"

#: CRC-32 of a text's bytes: `crc` has the table of the polynomial, eight shifts for each byte value.
CRC_TABLE = """crc AS (SELECT list(list_reduce(range(0, 8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) ORDER BY n) AS crc FROM range(0, 256) r(n))"""


def crc32(text: str) -> str:
    """In a query that joins `crc`."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda p: CAST('0x' || p AS BIGINT))"
    return f"xor(list_reduce({octets}, lambda c, b: xor(crc.crc[xor(c, b) % 256 + 1], c >> 8), 4294967295), 4294967295)"


def _mixing() -> str:
    """Each level: the children of the nodes before, filled up by weight, then by capacity."""
    weight = {
        1: "CASE d WHEN '=d0' THEN 4 WHEN '=d1' THEN 3 WHEN '=d2' THEN 2 WHEN '=d3' THEN 1 ELSE 1 END",
        2: "CASE l WHEN '=en' THEN 5 WHEN '=de' THEN 2 WHEN '=fr' THEN 2 WHEN '=es' THEN 4 ELSE 1 END",
        3: "1",
    }
    keys = {1: ["d"], 2: ["d", "l"], 3: ["d", "l", "s"]}
    out = [
        rf"""slim AS (SELECT doc_id, lang, source, 'd' || CAST(CAST(regexp_extract(source, '[0-9]+') AS INT) % 4 AS VARCHAR) AS domain,
            CAST(len(regexp_extract_all(coalesce(text, ''), '{SPACED}')) AS BIGINT) AS tokens FROM documents)""",
        "named AS (SELECT *, coalesce('=' || domain, '-') AS d, coalesce('=' || lang, '-') AS l, coalesce('=' || source, '-') AS s FROM slim)",
        "share0 AS (SELECT CAST(floor(sum(tokens) * 0.5) AS BIGINT) AS share FROM named)",
    ]
    for depth, own in keys.items():
        key, parent = ", ".join(own), own[:-1]
        path, by = " || '/' || ".join(own), f"PARTITION BY {', '.join(parent)}" if parent else ""
        above = f"JOIN share{depth - 1} USING ({', '.join(parent)})" if parent else ", share0"
        budget = "share" if parent else "least(share, sum(capacity) OVER ())"
        out += [
            f"node{depth} AS (SELECT {key}, {path} AS path, CAST(sum(tokens) AS HUGEINT) AS tokens, CAST(sum(tokens) * 2 AS HUGEINT) AS capacity, CAST({weight[depth]} AS HUGEINT) AS weight FROM named GROUP BY {key} HAVING sum(tokens) > 0)",
            f"asked{depth} AS (SELECT n.*, CAST({budget} AS HUGEINT) AS budget FROM node{depth} n {above})",
            f"""full{depth} AS (SELECT *, CAST(capacity AS DOUBLE) / weight AS fill, capacity * sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                <= (budget - coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS ok
                FROM asked{depth} WINDOW w AS ({by} ORDER BY CAST(capacity AS DOUBLE) / weight, path))""",
            f"fed{depth} AS (SELECT *, min(CAST(ok AS INT)) OVER ({by} ORDER BY fill, path ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sated FROM full{depth})",
            f"""even{depth} AS (SELECT *, budget - coalesce(sum(CASE WHEN sated = 1 THEN capacity END) OVER ({by}), 0) AS rest, sum(CASE WHEN sated = 0 THEN weight END) OVER ({by}) AS every,
                sum(CASE WHEN sated = 0 THEN weight ELSE 0 END) OVER ({by} ORDER BY fill, path ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM fed{depth})""",
            f"""share{depth} AS (SELECT * FROM (SELECT {key}, tokens, CAST(CASE WHEN sated = 1 THEN capacity
                ELSE CAST(rest * upto AS HUGEINT) // CAST(every AS HUGEINT) - CAST(rest * (upto - weight) AS HUGEINT) // CAST(every AS HUGEINT) END AS BIGINT) AS share FROM even{depth}) WHERE share > 0)""",
        ]
    out += [
        "plan AS (SELECT d, l, s, CAST(share // tokens AS BIGINT) AS whole, CAST(share % tokens AS BIGINT) AS rest FROM share3)",
        "drawn AS (SELECT n.*, whole, rest, unnest(range(0, whole + 1)) AS epoch FROM named n JOIN plan USING (d, l, s))",
        "placed AS (SELECT *, md5('17:' || CAST(epoch AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR)) AS draw FROM drawn)",
        "summed AS (SELECT *, sum(tokens) OVER (PARTITION BY d, l, s, epoch ORDER BY draw, doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - tokens AS before FROM placed)",
    ]
    return "WITH " + ",\n".join(out) + """
        SELECT doc_id, domain, lang, source, tokens, epoch, draw, CAST(CASE WHEN epoch < whole THEN tokens ELSE least(tokens, rest - before) END AS BIGINT) AS taken
        FROM summed WHERE epoch < whole OR before < rest"""


SQL: dict[str, str] = {
    "op1_mixing": _mixing(),
    "op4_lm_score": rf"""
        WITH w AS (SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all({LOWER}, '{SPACED}') AS w FROM documents),
        p AS (SELECT row_no, unnest(range(1, len(w) + 1)) AS i, w FROM w), t AS (SELECT row_no, i, w[i] AS b, CASE WHEN i > 1 THEN w[i - 1] END AS a FROM p),
        one AS (SELECT b AS word, count(*) AS n FROM t GROUP BY b), two AS (SELECT a, b, count(*) AS n FROM t WHERE a IS NOT NULL GROUP BY a, b),
        total AS (SELECT count(*) AS n FROM t),
        s AS (SELECT row_no, count(*) AS n_words, sum(CASE WHEN t.a IS NULL THEN ln(ob.n / total.n) WHEN two.n >= 2 THEN ln(two.n) - ln(oa.n) ELSE ln(0.4 * ob.n / total.n) END) AS log_score
            FROM t JOIN one ob ON t.b = ob.word LEFT JOIN one oa ON t.a = oa.word LEFT JOIN two ON t.a = two.a AND t.b = two.b, total GROUP BY row_no)
        SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, round(coalesce(log_score, 0.0), 2) AS log_score, round(coalesce(log_score / n_words, 0.0), 4) AS mean
        FROM w LEFT JOIN s USING (row_no)""",
    "op5_exact_dedup": f"""
        WITH t AS (SELECT doc_id, sha256({LOWER}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)""",
    "op6_near_dedup": rf"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '{SPACED}') AS w FROM documents),
        p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, CASE WHEN len(w) > 0 THEN 1 ELSE 0 END) + 1)) AS i FROM w),
        sh AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS s FROM p),
        size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
        link AS (SELECT a, b FROM common JOIN size m ON m.doc_id = a JOIN size k ON k.doc_id = b WHERE 100 * common.n >= 75 * (m.n + k.n - common.n)),
        both_ AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, both_.b FROM reach JOIN both_ ON reach.b = both_.a)
        SELECT w.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
        FROM w LEFT JOIN size USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)""",
    # Texts as hexadecimal digits, two for a byte, in pieces so that no place is far from its piece's start.
    "op9_repeats": """
        WITH t AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        n AS (SELECT *, CAST(length(x) // 2 AS BIGINT) AS n FROM t),
        c AS (SELECT r, x, n, unnest(range(0, greatest(n - 399, 0), 200)) AS base FROM n),
        k AS (SELECT r, base, substr(x, 2 * base + 1, 2 * 599) AS piece, unnest(range(0, least(200, n - 399 - base))) AS j FROM c),
        p AS MATERIALIZED (SELECT r, base + j AS pos, md5(substr(piece, 2 * j + 1, 800)) AS s FROM k),
        h AS (SELECT r, pos FROM p JOIN (SELECT s FROM p GROUP BY s HAVING count(*) > 1) USING (s)),
        g AS (SELECT r, pos, CASE WHEN pos <= lag(pos) OVER (PARTITION BY r ORDER BY pos) + 400 THEN 0 ELSE 1 END AS fresh FROM h),
        i AS (SELECT r, pos, sum(fresh) OVER (PARTITION BY r ORDER BY pos) AS run FROM g),
        u AS (SELECT r, min(pos) AS a, max(pos) + 400 AS b FROM i GROUP BY r, run),
        e AS (SELECT *, lead(a) OVER (PARTITION BY r ORDER BY a) AS after FROM u),
        z AS (SELECT r, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans,
            any_value(substr(x, 1, 2 * first)) || string_agg(substr(x, 2 * b + 1, 2 * (coalesce(after, n) - b)), '' ORDER BY a) AS kept
            FROM (SELECT e.*, min(a) OVER (PARTITION BY r) AS first FROM e) JOIN n USING (r) GROUP BY r)
        SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
        FROM n LEFT JOIN z USING (r)""",
    "op10_decontaminate": rf"""
        WITH dw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        bw AS (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        bp AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0),
        ph AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS p FROM bp),
        sizes AS (SELECT DISTINCT n FROM ph),
        dp AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n),
        dg AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS p FROM dp),
        m AS (SELECT r, i, n, item_id FROM dg JOIN ph USING (n, p)),
        hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM m) GROUP BY r),
        it AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM m WHERE item_id IS NOT NULL) GROUP BY r),
        pos AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM dw),
        df AS (SELECT word, count(*) AS df FROM pos GROUP BY word),
        pd AS (SELECT DISTINCT p, n, CASE WHEN n >= 4 THEN 1 ELSE 0 END AS may_miss FROM ph),
        pt AS (SELECT *, unnest(string_split(p, ' ')) AS word, unnest(range(n)) AS o FROM pd),
        rk AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY df, o) AS rank, count(*) OVER (PARTITION BY p) AS known FROM pt JOIN df USING (word)),
        st AS (SELECT DISTINCT r, p, n, may_miss, pos - o AS s FROM rk JOIN pos USING (word) WHERE (rank = 1 AND known >= n - may_miss) OR (rank = 2 AND known = n AND may_miss = 1)),
        nr AS (SELECT r, p FROM st JOIN pt USING (p, n, may_miss) JOIN pos USING (r, word) WHERE pos BETWEEN s + o - 3 AND s + o + 3 GROUP BY r, p, s, n, may_miss HAVING count(DISTINCT o) >= n - may_miss),
        ni AS (SELECT r, count(*) AS n_near, string_agg(id, ',' ORDER BY id) AS near_ids FROM (
            SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM nr JOIN ph USING (p) WHERE item_id IS NOT NULL
            EXCEPT SELECT r, CAST(item_id AS VARCHAR) FROM m) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
            coalesce(n_near, 0) AS n_near_items, sha256(coalesce(near_ids, '')) AS near_items_sha256
        FROM dw LEFT JOIN hit USING (r) LEFT JOIN it USING (r) LEFT JOIN ni USING (r)""",
    "op11_sharding": f"""
        WITH {CRC_TABLE},
        t AS (SELECT doc_id, coalesce(text, '') AS text, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS key FROM documents),
        k AS (SELECT *, sum(size) OVER (ORDER BY key, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS start, sum(size) OVER (PARTITION BY key) AS key_bytes, count(*) OVER (PARTITION BY key) AS key_rows,
            greatest(1, CAST(ceil(sum(size) OVER () / 8) AS BIGINT)) AS due, count(*) OVER () AS n_rows FROM t),
        m AS (SELECT *, CASE WHEN key_bytes > due * 0.01 OR key_rows > greatest(1.0, n_rows / 8 * 0.01) THEN start + size // 2 ELSE min(start) OVER (PARTITION BY key) + key_bytes // 2 END AS middle FROM k),
        d AS (SELECT *, CAST(middle // due AS INT) AS shard FROM m)
        SELECT doc_id, size, {crc32("text")} AS text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY key, doc_id NULLS FIRST) - 1 AS slot, CAST(NULL AS INT) AS grown_shard
        FROM d, crc""",
    "op12_fill_middle": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        h AS (SELECT *, CAST(length(text) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM t),
        c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
            CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || substr(text, 1, a) || '<S>' || substr(text, b + 1) || '<M>' || substr(text, a + 1, b - a)
                ELSE '<S>' || substr(text, b + 1) || '<P>' || substr(text, 1, a) || '<M>' || substr(text, a + 1, b - a) END) AS output_sha256, sha256(text) AS restored_sha256
        FROM c""",
    "op13_prefix_trie": f"""
        WITH {CRC_TABLE},
        t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        m AS (SELECT conv_id, turn, text, md5(CAST(length(role) AS VARCHAR) || ':' || role || text) AS id FROM t),
        o AS (SELECT conv_id, text, id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS i FROM m),
        c AS (SELECT conv_id, {crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM o), crc),
        r AS (SELECT c.conv_id, 0 AS part, i, text, id FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 100 AND o.i <= c.h
            UNION ALL SELECT c.conv_id, 1, i, text, id FROM c JOIN o ON o.conv_id = c.conv_id AND o.i > c.h),
        d AS (SELECT conv_id, text, id, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS depth FROM r),
        p AS (SELECT conv_id, depth, text, string_agg(id, '/') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM d UNION ALL SELECT conv_id, 0, '', '' FROM c),
        e AS (SELECT *, lag(path) OVER w AS above, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
        n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(above) AS above, any_value(length(text)) AS points,
            coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends FROM e GROUP BY path, depth),
        k AS (SELECT above AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY above),
        u AS (SELECT DISTINCT x.path, y.path AS below FROM e x JOIN e y ON x.conv_id = y.conv_id AND x.depth <= y.depth),
        s AS (SELECT u.path, CAST(sum((n.n_convs - 1) * n.points) AS BIGINT) AS saved_tokens, count(*) FILTER (WHERE k.path IS NULL) AS n_leaves FROM u JOIN n ON n.path = u.below LEFT JOIN k ON k.path = u.below GROUP BY u.path)
        SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, sha256(n.ends) AS ends_sha256
        FROM n LEFT JOIN k USING (path) JOIN s USING (path) LEFT JOIN n up ON up.path = n.above AND n.depth > 0""",
}
