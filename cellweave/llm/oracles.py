"""DuckDB SQL for the numbered operators that SQL can express; the others are held against brute force in the tests."""

from __future__ import annotations

from .conversations import AFTER_INSERT, ASSISTANT, EMPTY, NEXT, USER
from .licenses import BETWEEN, TEMPLATES, Template
from .sharding import MULTIPLIERS

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
REACH = """reach AS (SELECT a AS node, b AS other FROM edge UNION SELECT r.node, e.b FROM reach r JOIN edge e ON e.a = r.other), comp AS (SELECT node, min(other) AS low FROM reach GROUP BY node)"""


def license_scan(least: float = 0.5) -> str:
    words = sorted({w for t in TEMPLATES for w in t.words})

    def weight(w: str) -> str:
        return f"g{words.index(w)}"

    def starts(t: Template) -> str:
        key = t.key.split()
        wanted = ", ".join(f"'{w}'" for w in key)
        return f"CASE WHEN len(ws) >= {len(key)} AND list_has_all(ws, [{wanted}]) THEN list_filter(range(1, len(ws) - {len(key)} + 2), lambda i: ws[i : i + {len(key) - 1}] = [{wanted}]) ELSE [] END"

    def share(k: int, t: Template) -> str:
        if t.base:
            return f"CASE WHEN len(s{k}) > 0 THEN 1.0 ELSE 0.0 END"
        got = [f"CASE WHEN i - {t.key_at} + {p} >= 1 AND ws[i - {t.key_at} + {p}] = '{w}' THEN {weight(w)} ELSE 0 END" for p, w in enumerate(t.words)]
        return f"coalesce(list_max(list_transform(s{k}, lambda i: least(1.0, round(({' + '.join(got)}) / ({' + '.join(weight(w) for w in t.words)}), 6)))), 0.0)"

    def named(ks: list[int]) -> str:
        items = ", ".join(f"CASE WHEN c{k} >= {least} THEN '{TEMPLATES[k].label}' END" for k in ks)
        return f"coalesce(array_to_string(list_sort(list_distinct([{items}])), ','), '')"

    base, all_ = [k for k, t in enumerate(TEMPLATES) if t.base], list(range(len(TEMPLATES)))
    flat = " || ".join(f"s{k}" for k in base)
    return f"""WITH w AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array({LOWERED}, '{BETWEEN}'), lambda x: x <> '') AS ws FROM documents),
    df AS (SELECT word, count(*) AS n FROM (SELECT DISTINCT rid, unnest(ws) AS word FROM w) WHERE word IN ({", ".join(f"'{w}'" for w in words)}) GROUP BY word),
    weight AS (SELECT word, ln(((SELECT count(*) FROM w) + 1.0::DOUBLE) / (coalesce(n, 0) + 1)) + 1 AS g FROM (SELECT unnest([{", ".join(f"'{w}'" for w in words)}]) AS word) LEFT JOIN df USING (word)),
    one AS (SELECT {", ".join(f"max(g) FILTER (word = '{w}') AS g{k}" for k, w in enumerate(words))} FROM weight),
    s AS (SELECT doc_id, ws, one.*, {", ".join(f"{starts(t)} AS s{k}" for k, t in enumerate(TEMPLATES))} FROM w, one),
    c AS (SELECT *, {", ".join(f"CAST({share(k, t)} AS DOUBLE) AS c{k}" for k, t in enumerate(TEMPLATES))} FROM s)
    SELECT doc_id, len(ws)::BIGINT AS n_words, len({flat})::BIGINT AS n_base, list_min({flat}) - 1 AS first_word, list_max({flat}) - 1 AS last_word, {named(base)} AS base_labels, {named(all_)} AS labels,
    greatest({", ".join(f"CASE WHEN c{k} >= {least} THEN c{k} ELSE 0.0 END" for k in all_)})::DOUBLE AS score FROM c"""


JACCARD = rf"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array({LOWERED}, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    near AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2) JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * common >= 75 * (p.n + q.n - common)),
    edge AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near), {REACH}
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(comp.low, w.doc_id)) AS component_id FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN comp ON comp.node = w.doc_id"""

DEDUP = f"""WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL),
    edge AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id WHERE x.n > 0 AND y.n > 0 AND list_dot_product(x.e, y.e) / (x.n * y.n) >= 0.98), {REACH}, k AS (SELECT a, count(*) AS n FROM edge GROUP BY a)
    SELECT vec_id, coalesce(k.n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id <= coalesce(low, vec_id) AS kept FROM embeddings LEFT JOIN k ON k.a = vec_id LEFT JOIN comp ON node = vec_id"""


def sharding_sql(shards: int, key: int) -> str:
    """Row numbers, a Feistel network of four rounds walked until it is back in range, and the checksum from its table."""
    bytes_ = "list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    entry = "list_reduce(list_prepend(i, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"

    def once(source: str, x: str) -> str:
        sql = f"SELECT rid, n, half, {x} >> half AS l, {x} & ((1::BIGINT << half) - 1) AS r FROM {source}"
        for k, m in enumerate(MULTIPLIERS):
            mixed = f"((xor(r, {key >> 8 * k & 0xFFFF}) * {m} + {key & 0x7FFFFFFF}) & 2147483647)"
            sql = f"SELECT rid, n, half, r AS l, xor(l, xor({mixed}, {mixed} >> 15) & ((1::BIGINT << half) - 1)) AS r FROM ({sql})"
        return f"SELECT rid, n, half, (l << half) | r AS x FROM ({sql})"

    return f"""WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, {entry} AS v FROM range(256) t(i))), b AS (SELECT doc_id, text, {bytes_} AS bs FROM documents),
    d AS (SELECT doc_id, len(bs)::BIGINT + 1 AS size, CAST(xor(list_reduce(list_prepend(4294967295::BIGINT, bs), lambda x, y: xor(x >> 8, tab[1 + (xor(x, y) & 255)])), 4294967295) AS BIGINT) AS text_crc32 FROM b, tab),
    e AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS rid, count(*) OVER () AS n FROM d), f AS (SELECT *, greatest(1, (length(bin(greatest(n, 2) - 1)) + 1) // 2) AS half FROM e),
    walk AS (({once("f", "rid")}) UNION ALL ({once("walk WHERE x >= n", "x")}))
    SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(x % {shards} AS INT) AS shard, CAST(x // {shards} AS BIGINT) AS slot, NULL::INT AS grown_shard FROM f JOIN walk USING (rid) WHERE x < walk.n"""


def merkle_sql() -> str:
    """Trees level by level in recursive tables, siblings by index, and each proof folded as a list."""
    value = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)) END"
    leaf = lambda n: f"sha256(concat({', '.join(map(value, ('doc_id', 'source', 'lang', n, 'text')))}))"
    entry = "list_reduce(list_prepend(i, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    digits = "list_transform(regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), lambda c: CAST(ascii(c) AS BIGINT))"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda x, y: xor(x >> 8, tab[1 + (xor(x, y) & 255)])), 4294967295)"
    up = lambda t, g: f"SELECT {g}lvl + 1 AS lvl, idx // 2 AS idx, (n + 1) // 2 AS n, sha256(string_agg(h, '' ORDER BY idx)) AS h FROM {t} WHERE n > 1 GROUP BY {g}lvl, idx // 2, n"
    return f"""WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, {entry} AS v FROM range(256) t(i))),
    c AS (SELECT *, CASE WHEN {crc} % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS n_shown FROM documents, tab),
    d AS (SELECT row_number() OVER () AS rid, doc_id, lang, {leaf("n_chars")} AS leaf, {leaf("n_shown")} AS shown FROM c),
    l AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, n FROM (SELECT lang, count(*) AS n FROM d GROUP BY lang)),
    p AS (SELECT d.*, g, n, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM d JOIN l ON l.lang IS NOT DISTINCT FROM d.lang),
    tree AS (SELECT g, 0::BIGINT AS lvl, idx, n, leaf AS h FROM p UNION ALL {up("tree", "g, ")}),
    sub AS (SELECT g, h AS subroot FROM tree WHERE n = 1),
    top AS (SELECT 0::BIGINT AS lvl, g AS idx, (SELECT count(*) FROM l) AS n, subroot AS h FROM sub UNION ALL {up("top", "")}),
    levels AS (SELECT DISTINCT g, lvl FROM tree WHERE n > 1), above AS (SELECT DISTINCT lvl FROM top WHERE n > 1),
    step AS (SELECT p.rid, v.lvl AS k, coalesce(t.h, '') AS h, (p.idx >> v.lvl) & 1 = 1 AS behind FROM p JOIN levels v ON v.g = p.g LEFT JOIN tree t ON t.g = p.g AND t.lvl = v.lvl AND t.idx = xor(p.idx >> v.lvl, 1)
        UNION ALL SELECT p.rid, 1000 + v.lvl, coalesce(t.h, ''), (p.g >> v.lvl) & 1 = 1 FROM p CROSS JOIN above v LEFT JOIN top t ON t.lvl = v.lvl AND t.idx = xor(p.g >> v.lvl, 1)),
    path AS (SELECT rid, sha256(string_agg(h, '' ORDER BY k)) AS proof, list(CASE WHEN behind THEN concat('L', h) ELSE concat('R', h) END ORDER BY k) AS steps FROM step GROUP BY rid),
    f AS (SELECT p.*, coalesce(proof, sha256('')) AS proof_sha256, list_reduce(list_prepend(shown, coalesce(steps, [])), lambda x, y: sha256(CASE WHEN y[1] = 'L' THEN concat(y[2:], x) ELSE concat(x, y[2:]) END)) AS folded_root FROM p LEFT JOIN path USING (rid))
    SELECT doc_id, leaf, subroot, r.h AS root, proof_sha256, folded_root, folded_root = r.h AS verified FROM f JOIN sub USING (g), (SELECT h FROM top WHERE n = 1) r"""


def repair_sql() -> str:
    """Rows in order, and for each of four states the least (cost, audit, repaired text) that leads there, row by row."""
    entry = "list_reduce(list_prepend(i, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    codes = "list_transform(regexp_extract_all(concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')), '.'), lambda c: CAST(ascii(c) AS BIGINT))"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda x, y: xor(x >> 8, tab[1 + (xor(x, y) & 255)])), 4294967295)"
    names = {USER: "user", ASSISTANT: "assistant"}

    def way(state: int, cost: str, letters: str, lines: list[str]) -> str:
        text = f"w{state}.x"
        for line in lines:
            text = f"concat({text}, CASE WHEN {text} = '' THEN '' ELSE chr(10) END, {line})"
        return f"{{'c': w{state}.c + {cost}, 'a': concat(w{state}.a, '{letters}'), 'x': {text}}}"

    def ways(row: bool) -> list[str]:
        found: list[list[str]] = [[] for _ in range(4)]
        for state in range(4):
            at, letters, lines = state, "", []
            for k in range(3):
                if not row:
                    found[at].append(f"CASE WHEN w{state} IS NOT NULL THEN {way(state, str(3 * k), letters, lines)} END")
                else:
                    after = AFTER_INSERT[at]
                    found[at].append(f"CASE WHEN w{state} IS NOT NULL THEN {way(state, str(3 * k + 4), letters + 'D', lines)} END")
                    line = "concat('" + names[after] + ":', text)"
                    found[after].append(f"CASE WHEN w{state} IS NOT NULL AND fault < 2 THEN {way(state, f'{3 * k + 3} + 3 * fault', letters + 'R', [*lines, line])} END")
                    for role, to in NEXT.items():
                        if at in to:
                            found[to[at]].append(f"CASE WHEN w{state} IS NOT NULL AND fault < 2 AND initial = '{role}' THEN {way(state, f'{3 * k} + 3 * fault', letters + 'K', [*lines, 'concat(role, chr(58), text)'])} END")
                at, letters, lines = AFTER_INSERT[at], letters + "I", [*lines, f"'{names[AFTER_INSERT[at]]}:'"]
        return [f"list_min(list_filter([{', '.join(x)}], lambda v: v IS NOT NULL))" for x in found]

    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    states = ", ".join(f"{x} AS w{k}" for k, x in enumerate(ways(True)))
    ends = ways(False)
    none = "NULL::STRUCT(c BIGINT, a VARCHAR, x VARCHAR)"
    return f"""WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, {entry} AS v FROM range(256) t(i))),
    k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS kind FROM conversations, tab),
    d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE kind <> 0),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, rtrim(text, {space}) AS body, substr(role, 1, 1) AS initial FROM d),
    r AS (SELECT *, CASE WHEN body = '' THEN 2 WHEN nth > 1 THEN 3 WHEN right(body, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS fault, concat(lag(initial) OVER (PARTITION BY conv_id ORDER BY i), initial) AS pair FROM o),
    c AS (SELECT DISTINCT conv_id FROM conversations),
    s AS (SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 2) AS blank, count(*) FILTER (fault = 3) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
        count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
    dp AS (SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'x': ''}}::STRUCT(c BIGINT, a VARCHAR, x VARCHAR) AS w0, {none} AS w1, {none} AS w2, {none} AS w3 FROM c
        UNION ALL SELECT dp.conv_id, r.i, {states} FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1),
    e AS (SELECT c.conv_id, coalesce(rows, 0) AS rows, gaps, blank, duplicate, truncated, illegal FROM c LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM c.conv_id),
    f AS (SELECT e.*, list_min(list_filter([{ends[EMPTY]}, {ends[ASSISTANT]}], lambda v: v IS NOT NULL)) AS best FROM e JOIN dp ON dp.conv_id IS NOT DISTINCT FROM e.conv_id AND dp.i = e.rows)
    SELECT conv_id, {", ".join(f"CAST(coalesce({x}, 0) AS BIGINT) AS {x}" for x in ("gaps", "blank", "duplicate", "truncated", "illegal"))}, best.c AS cost, best.a AS audit, sha256(best.x) AS repaired_sha256 FROM f"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": license_scan(), "op3_sharding": sharding_sql(8, 20240501), "op4_ngram_jaccard": JACCARD, "op7_embedding_dedup": DEDUP, "op11_merkle_manifest": merkle_sql(), "op13_conversation_repair": repair_sql()}
