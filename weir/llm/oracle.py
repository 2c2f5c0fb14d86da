"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from weir.llm import mixing, quality

_WORD = r"[^\x20\x09-\x0D]+"


def _mixing() -> str:
    weights = [mixing.integral(s) for s in mixing.SCHEDULES]
    weight = " ".join(f"WHEN {i} THEN CAST({w!r} AS DOUBLE)" for i, w in enumerate(weights))

    def time(schedule: mixing.Schedule) -> str:
        total, done, cases = mixing.integral(schedule), 0.0, []
        for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
            area = (t1 - t0) * (w0 + w1) / 2
            slope = (w1 - w0) / (t1 - t0)
            left = f"(share * CAST({total!r} AS DOUBLE) - CAST({done!r} AS DOUBLE))"
            x = (f"2 * {left} / (CAST({w0!r} AS DOUBLE) + "
                 f"sqrt(greatest(CAST({w0 * w0!r} AS DOUBLE) + CAST({2 * slope!r} AS DOUBLE) * {left}, CAST(0 AS DOUBLE))))")
            cases.append(f"WHEN share * CAST({total!r} AS DOUBLE) <= CAST({done + area!r} AS DOUBLE) THEN "
                         f"CASE WHEN {left} <= 0 THEN CAST({t0!r} AS DOUBLE) ELSE CAST({t0!r} AS DOUBLE) + {x} END")
            done += area
        end = f"CAST({schedule[-1][0]!r} AS DOUBLE)"
        return f"least(CASE {' '.join(cases)} ELSE {end} END, {end})"

    times = " ".join(f"WHEN {i} THEN {time(s)}" for i, s in enumerate(mixing.SCHEDULES))
    return f"""
WITH base AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
ranked AS (
  SELECT *, CAST(source_size AS DOUBLE) * {mixing.CAP} AS brim, CASE turn {weight} END AS weight
  FROM (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(weights)} AS turn FROM sizes)),
shared AS (
  SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(brim) OVER up, 0)) / sum(weight) OVER down AS part
  FROM ranked
  WINDOW up AS (ORDER BY brim / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         down AS (ORDER BY brim / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
goal AS (
  SELECT source, source_size, turn,
         least(brim, coalesce(max(CASE WHEN part <= brim / weight THEN part END) OVER (), 0) * weight) AS target
  FROM shared),
run AS (
  SELECT b.doc_id, b.size, g.source_size, g.turn, g.target,
         CAST(sum(b.size) OVER (PARTITION BY b.source ORDER BY b.h, b.doc_id NULLS FIRST, b.size
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - b.size AS DOUBLE)
           + CAST(b.size AS DOUBLE) / 2 AS middle,
         CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END AS laps
  FROM base b JOIN goal g ON b.source IS NOT DISTINCT FROM g.source),
taken AS (
  SELECT *, CASE WHEN size = 0 THEN 0
                 ELSE laps + CASE WHEN middle < target - laps * source_size THEN 1 ELSE 0 END END AS times
  FROM run),
shares AS (
  SELECT *, CASE WHEN times > 0 THEN least(middle / target, CAST(1 AS DOUBLE)) END AS share FROM taken)
SELECT doc_id, size, source_size, target, CAST(times * size AS BIGINT) AS taken,
       CASE WHEN times > 0 THEN CASE turn {times} END END AS position
FROM shares"""


def _quality() -> str:
    bits = quality.BITS
    measures = list(quality.MEASURES)
    cell = (f"CASE WHEN value < {1 << bits} THEN value "
            f"ELSE (value >> (length(bin(value)) - {bits})) << (length(bin(value)) - {bits}) END")

    def share(part: str, whole: str, unit: int) -> str:
        return f"CASE WHEN {whole} > 0 THEN {part} * {unit} // {whole} ELSE 0 END"

    unpivot = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS measure, {m} AS value FROM judged WHERE NOT base_failed" for m in measures)

    def quartiles(name: str, by: str) -> str:
        keys = f"{by}, " if by else ""
        return f"""
{name} AS (
  SELECT {keys}measure, max(n) AS docs, min(CASE WHEN 4 * upto >= n THEN cell END) AS q1,
         min(CASE WHEN 4 * upto >= 3 * n THEN cell END) AS q3
  FROM (SELECT {keys}measure, cell,
               sum(docs) OVER (PARTITION BY {keys}measure ORDER BY cell ROWS UNBOUNDED PRECEDING) AS upto,
               sum(docs) OVER (PARTITION BY {keys}measure) AS n
        FROM (SELECT {keys}measure, cell, sum(docs) AS docs FROM cells GROUP BY {keys}measure, cell))
  GROUP BY {keys}measure)"""

    fences, tests = [], []
    for m, (low, slack) in quality.MEASURES.items():
        wide = f"({quality.SPREAD} * (q3 - q1) + {slack})"
        fences.append(f"max(CASE WHEN measure = '{m}' THEN q3 + {wide} END) AS {m}_high")
        tests.append(f"coalesce({m} <= {m}_high, false)")
        if low:
            fences.append(f"max(CASE WHEN measure = '{m}' THEN q1 - {wide} END) AS {m}_low")
            tests.append(f"coalesce({m} >= {m}_low, false)")
    return rf"""
WITH split AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
numbered AS (SELECT row_number() OVER () AS r, * FROM split),
places AS (
  SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS k
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM numbered)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM places) WHERE n > 1),
repeats AS (
  SELECT r, count(DISTINCT j) AS n
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY r),
base AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines
  FROM numbered LEFT JOIN repeats USING (r)),
judged AS (
  SELECT *, {share('word_chars', 'n_words', 1000)} AS word_length_milli,
         {share('n_symbols', 'n_words', 1_000_000)} AS symbols_ppm,
         {share('n_dup_lines', 'n_lines', 1_000_000)} AS dup_lines_ppm,
         {share('n_repeat_words', 'n_words', 1_000_000)} AS repeat_words_ppm,
         n_words < {quality.BASE_WORDS} OR 100 * n_repeat_words > {quality.BASE_REPEAT_PERCENT} * n_words AS base_failed
  FROM base),
cells AS (
  SELECT lang, source, measure, {cell} AS cell, count(*) AS docs
  FROM ({unpivot}) GROUP BY ALL),{quartiles('fine', 'lang, source')},{quartiles('of_lang', 'lang')},{quartiles('every', '')},
chosen AS (
  SELECT fine.lang, fine.source, fine.measure,
         CASE WHEN fine.docs >= {quality.MIN_ROWS} THEN fine.q1 WHEN of_lang.docs >= {quality.MIN_ROWS} THEN of_lang.q1 ELSE every.q1 END AS q1,
         CASE WHEN fine.docs >= {quality.MIN_ROWS} THEN fine.q3 WHEN of_lang.docs >= {quality.MIN_ROWS} THEN of_lang.q3 ELSE every.q3 END AS q3
  FROM fine JOIN of_lang ON fine.lang IS NOT DISTINCT FROM of_lang.lang AND fine.measure = of_lang.measure
            JOIN every ON fine.measure = every.measure),
fences AS (SELECT lang, source, {', '.join(fences)} FROM chosen GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(tests)} AS kept
FROM judged LEFT JOIN fences ON judged.lang IS NOT DISTINCT FROM fences.lang
                            AND judged.source IS NOT DISTINCT FROM fences.source"""


_EXACT = """
WITH rows AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS folded FROM documents),
grouped AS (SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, sha256(folded) AS text_sha256,
                   row_number() OVER (PARTITION BY folded ORDER BY doc_id DESC NULLS LAST) AS place
            FROM rows WINDOW same AS (PARTITION BY folded))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM grouped"""


def _trie() -> str:
    # CRC-32 of the decimal digits, bit by bit
    crc = """xor(4294967295, list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda crc, code: list_reduce([xor(crc, code), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, step: xor(v >> 1, 3988292384 * (v & 1)))))"""
    return f"""
WITH whole AS (
  SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn ASC NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
headed AS (SELECT c, turns, {crc} % 9 AS h FROM whole),
rebuilt AS (
  SELECT headed.c, list_concat(coalesce(whole.turns[1:h], []), headed.turns[h + 1:]) AS turns
  FROM headed LEFT JOIN whole ON whole.c = headed.c - headed.c % 5),
prefixes AS (SELECT c, depth, turns[1:depth] AS path, len(turns) AS n FROM rebuilt, unnest(range(0, len(turns) + 1)) AS r(depth)),
nodes AS (
  SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE coalesce(strlen(path[depth].text), 0) END AS saved,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY path, depth),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
below AS (
  SELECT full_nodes.path[1:d] AS path, CAST(sum(saved) AS BIGINT) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM full_nodes, unnest(range(0, depth + 1)) AS r(d) GROUP BY ALL)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
FROM full_nodes AS f JOIN below USING (path) LEFT JOIN nodes AS p ON f.depth > 0 AND p.path = f.path[1:f.depth - 1]"""


SQL: dict[str, str] = {
    "op2_quality_rules": _quality(),
    "op3_mixing": _mixing(),
    "op12_exact_dedup": _EXACT,
    "op13_prefix_trie": _trie(),
}
