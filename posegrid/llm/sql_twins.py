"""SQL twins of the training-data queries that need more than a line."""

from __future__ import annotations

from posegrid.llm import risk_rules


def quality_rules() -> str:
    """Counts, base rules, exact binomial bounds and chosen cutoffs of operator 1, for DuckDB."""
    grid = ", ".join(f"('{rule}', {cell}, {cut!r}::DOUBLE)" for rule, cuts in risk_rules.GRID.items()
                     for cell, cut in enumerate(cuts, 1))
    rules = len(risk_rules.GRID)
    share = risk_rules.RISK / rules
    sym = risk_rules.SYMBOLS
    return f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(lang, '') AS strat, coalesce(text, '') AS t FROM documents),
 s AS (SELECT n, doc_id, strat, t, [x FOR x IN string_split_regex(t, '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w,
   [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS l FROM d),
 pos AS (SELECT n, unnest(range(1, len(w) - 1)) AS i FROM s WHERE len(w) >= 3),
 win AS (SELECT n, i, w[i] || chr(0) || w[i + 1] || chr(0) || w[i + 2] AS x FROM pos JOIN s USING (n)),
 rep AS (SELECT n, i FROM (SELECT *, count(*) OVER (PARTITION BY n, x) AS c FROM win) WHERE c > 1),
 cov AS (SELECT n, count(DISTINCT i + k) AS c FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY 1),
 m AS (SELECT n, doc_id, strat, len(w) AS n_words, len(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
   len(regexp_replace(t, '[^{sym}]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines,
   coalesce(c, 0) AS n_repeat_words, len(regexp_extract_all(t, '\\p{{Lu}}\\p{{Lu}}')) AS caps, len(regexp_replace(t, '[^!]', '', 'g')) AS excl
   FROM s LEFT JOIN cov USING (n)),
 b AS (SELECT *, n_words < {risk_rules.LEAST_WORDS} OR 100 * n_repeat_words > {risk_rules.MOST_REPEATED} * n_words AS base_failed FROM m),
 v AS (SELECT n, doc_id, strat, base_failed, unnest([
   {{'rule': 'symbol_share', 'v': n_symbols / greatest(word_chars, 1)}},
   {{'rule': 'duplicate_line_share', 'v': n_dup_lines / greatest(n_lines, 1)}},
   {{'rule': 'repeated_word_share', 'v': n_repeat_words / greatest(n_words, 1)}},
   {{'rule': 'capital_pair_share', 'v': caps / greatest(word_chars, 1)}},
   {{'rule': 'exclamation_share', 'v': excl / greatest(n_words, 1)}},
   {{'rule': 'word_length', 'v': word_chars / greatest(n_words, 1)}}], recursive := true) FROM b),
 grid(rule, cell, cutoff) AS (VALUES {grid}),
 marks AS (SELECT doc_id, min(quality) AS q FROM labels WHERE quality IN (0, 1) GROUP BY 1),
 held AS (SELECT strat, rule, v, q FROM v JOIN marks USING (doc_id) WHERE NOT base_failed),
 ladder AS (SELECT h.strat, g.rule, g.cell, g.cutoff, count(*) FILTER (WHERE v >= cutoff AND q = 1) AS lost,
   count(*) FILTER (WHERE v >= cutoff AND q = 0) AS caught FROM held h JOIN grid g USING (rule) GROUP BY ALL),
 size AS (SELECT strat, count(*) FILTER (WHERE q = 1 AND rule = 'word_length') AS size,
   (SELECT count(DISTINCT strat) FROM held) AS strata FROM held GROUP BY 1),
 ser AS (SELECT strat, size, strata, unnest(range(0, CAST(floor(size * {share!r}) AS BIGINT) + 1)) AS k FROM size),
 term AS (SELECT *, size * ln(1 - {share!r}) + coalesce(sum(ln((size - k) / (k + 1)) + ln({share!r} / (1 - {share!r}))) OVER (
   PARTITION BY strat ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lt FROM ser),
 tail AS (SELECT *, sum(exp(lt)) OVER (PARTITION BY strat ORDER BY k) AS p FROM term),
 most AS (SELECT strat, max(k) AS most FROM tail WHERE p <= {risk_rules.DELTA!r} / ({rules} * strata) GROUP BY 1),
 chosen AS (SELECT strat, rule, arg_max(cutoff, (caught - {risk_rules.PRICE!r} * lost, cell)) AS cutoff FROM ladder JOIN most USING (strat)
   WHERE lost <= most AND caught - {risk_rules.PRICE!r} * lost > 0 GROUP BY 1, 2),
 bad AS (SELECT DISTINCT n FROM v JOIN chosen USING (strat, rule) WHERE v >= cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n NOT IN (SELECT n FROM bad) AS kept FROM b"""


def merkle_manifest() -> str:
    """Levels, proofs and folded roots of operator 11, with CRC-32 by its bits, for DuckDB."""
    leaf = lambda text: "sha256(" + " || ".join(
        f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    parent = "sha256(string_agg(h, '' ORDER BY p))"
    step = """sha256(array_to_string(list_concat(hs[:p % 3], [f], hs[p % 3 + 2:]), '')),
   s || array_to_string(list_concat(hs[:p % 3], hs[p % 3 + 2:]), '')"""
    return f"""
WITH RECURSIVE bits AS (SELECT *, list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(
   string_split(doc_id::VARCHAR, ''), lambda c: [ord(c)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
   lambda a, e: xor(xor(a, e) >> 1, (xor(a, e) & 1) * 3988292384)) AS crc FROM documents),
 c AS (SELECT *, CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed FROM bits),
 o AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS t, count(*) OVER (PARTITION BY source) AS n,
   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM (
   SELECT row_number() OVER () AS rid, doc_id, source, {leaf('text')} AS leaf, {leaf('changed')} AS tested FROM c)),
 lv(t, l, p, n, h) AS (SELECT t, 0, p, n, leaf FROM o UNION ALL
   SELECT t, l + 1, p // 3, (any_value(n) + 2) // 3, {parent} FROM lv WHERE n > 1 GROUP BY t, l, p // 3),
 tv(t, l, p, n, h) AS (SELECT 0::BIGINT, 0, t - 1, (SELECT max(t) FROM o), h FROM lv WHERE n = 1 UNION ALL
   SELECT t, l + 1, p // 3, (any_value(n) + 2) // 3, {parent} FROM tv WHERE n > 1 GROUP BY t, l, p // 3),
 runs AS (SELECT t, l, p // 3 AS q, list(h ORDER BY p) AS hs FROM (FROM lv UNION ALL FROM tv) WHERE n > 1 GROUP BY ALL),
 low(rid, t, l, p, f, s) AS (SELECT rid, t, 0, p, tested, '' FROM o UNION ALL
   SELECT rid, t, l + 1, p // 3, {step} FROM low JOIN runs USING (t, l) WHERE p // 3 = q),
 top(rid, t, l, p, f, s) AS (SELECT rid, 0::BIGINT, 0, t - 1, f, s FROM low
   WHERE (t, l) IN (SELECT (t, l) FROM lv WHERE n = 1) UNION ALL
   SELECT rid, t, l + 1, p // 3, {step} FROM top JOIN runs USING (t, l) WHERE p // 3 = q),
 root AS (SELECT l, h FROM tv WHERE n = 1)
SELECT doc_id, leaf, sub.h AS subroot, root.h AS root, sha256(s) AS proof_sha256, f AS folded_root, f = root.h AS verified
FROM o JOIN (SELECT t, h FROM lv WHERE n = 1) sub USING (t) JOIN top USING (rid) JOIN root ON top.l = root.l"""
