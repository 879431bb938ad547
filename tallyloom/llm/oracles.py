"""The queries of this folder that SQL can express, for DuckDB."""

from __future__ import annotations

from . import line_dedup as L
from . import mixing as M
from . import ngram_join as J
from . import quality as Q
from . import url_filters as U
from . import vector_dedup as V
from .common import WORD

WORDS = f"regexp_extract_all(coalesce(text, ''), '{WORD}')"
SPACES = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


# RE2 knows no possessive and no look-around forms.  Twice the characters between words give
# every phrase delimiters of its own, so that neighbours do not take each other's.
SYMBOL_WORD = Q.SYMBOL_WORD.removeprefix(r"(?<![^\x20\x09-\x0D])").replace("*+", "*") + r"[^\x20\x09-\x0D]*"
PHRASE = r"(?i)(?:^|[^\p{L}\p{N}])(?:" + Q.FURNITURE.removeprefix("(?i)").replace(" ", "  ") + r")(?:[^\p{L}\p{N}]|$)"


def _found(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


def _fails(line: str) -> str:
    words = _found(line, WORD)
    spread = f"regexp_replace({line}, '([^\\p{{L}}\\p{{N}}])', '\\1\\1', 'g')"
    furniture = f"array_to_string(regexp_extract_all({spread}, '{PHRASE}'), ' ')"
    return f"""(regexp_matches({line}, '{WORD}') AND (
      NOT regexp_matches({line}, '{Q.SENTENCE_END}')
      OR {_found(line, Q.SHOUT)} * 2 > {words}
      OR ({_found(line, Q.SEPARATOR)} >= 2 AND {_found(line, Q.SEPARATOR)} * 3 >= {words})
      OR (regexp_matches({line}, '{Q.FURNITURE}') AND {_found(furniture, WORD)} > 0
        AND {_found(furniture, WORD)} * 10 >= {words} * 3)
      OR {_found(line, SYMBOL_WORD)} * 10 >= {words} * 3))"""


def quality_sql(docs: str) -> str:
    """Common table expressions that end in ``judged``, over a table of documents."""
    return f"""numbered AS (SELECT row_number() OVER () AS rid, * FROM {docs}),
  worded AS (SELECT rid, {WORDS} AS words, string_split(coalesce(text, ''), chr(10)) AS lines FROM numbered),
  windows AS (SELECT rid, i, list_aggregate(words[i:i + {Q.WINDOW - 1}], 'string_agg', ' ') AS w
    FROM worded, unnest(generate_series(1, len(words) - {Q.WINDOW - 1})) AS g(i)),
  repeated AS (SELECT rid, i FROM windows WHERE (rid, w) IN
    (SELECT (rid, w) FROM windows GROUP BY rid, w HAVING count(*) > 1)),
  covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM repeated, unnest(generate_series(0, {Q.WINDOW - 1})) AS g(k)
    GROUP BY rid),
  measured AS (SELECT d.*, len(words) AS n_words,
      length(translate(coalesce(text, ''), {SPACES}, '')) AS word_chars,
      length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{Q.SYMBOLS}', '')) AS n_symbols,
      len(list_filter(lines, lambda l: regexp_matches(l, '{WORD}')))
        - len(list_distinct(list_filter(lines, lambda l: regexp_matches(l, '{WORD}')))) AS n_dup_lines,
      coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
      list_filter(lines, lambda l: NOT {_fails('l')}) AS good
    FROM numbered d JOIN worded USING (rid) LEFT JOIN covered USING (rid)),
  cleaned AS (SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed,
      n_lines - len(good) AS n_bad_lines, array_to_string(good, chr(10)) AS clean_text FROM measured),
  judged AS (SELECT *, n_words - {_found('clean_text', WORD)} AS lost_words,
      NOT base_failed AND (n_words - {_found('clean_text', WORD)}) * 100 <= n_words * {Q.MAX_LOST_PERCENT} AS kept
    FROM cleaned)"""


OP1 = f"""WITH {quality_sql('documents')}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_bad_lines,
  lost_words, sha256(clean_text) AS clean_sha256 FROM judged"""


def line_dedup_sql(docs: str) -> str:
    """Common table expressions that end in ``deduped``, over a table of documents."""
    return f"""lined AS (SELECT row_number() OVER () AS rid, coalesce(doc_id, 9223372036854775807) AS did,
      string_split(coalesce(text, ''), chr(10)) AS lines, * FROM {docs}),
  exploded AS (SELECT rid, did, i, lines[i] AS line,
      translate(trim(lines[i], {SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM lined, unnest(generate_series(1, len(lines))) AS g(i)),
  frequent AS (SELECT k, min(did) AS keeper FROM exploded WHERE length(k) >= {L.MIN_CHARS}
    GROUP BY k HAVING count(DISTINCT did) >= {L.MIN_DOCS}),
  marked AS (SELECT rid, i, line, coalesce(keeper <> did, false) AS gone FROM exploded LEFT JOIN frequent USING (k)),
  assembled AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
      coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept_text FROM marked GROUP BY rid),
  deduped AS (SELECT lined.*, n_lines, n_dropped, kept_text FROM lined JOIN assembled USING (rid))"""


OP2 = f"""WITH {line_dedup_sql('documents')}
SELECT doc_id, n_lines, n_dropped, sha256(kept_text) AS kept_sha256 FROM deduped"""


def mixing_sql(docs: str) -> str:
    """Common table expressions that end in ``mixed``: targets by checking every possible set of capped sources."""
    weight = "[" + ", ".join(map(str, M.WEIGHTS)) + "]"
    rise = ["[" + ", ".join(f"{s[k]}::DOUBLE" for s in M.SCHEDULES) + "]" for k in (0, 1)]
    return f"""sized AS (SELECT row_number() OVER () AS rid, doc_id, source, len({WORDS})::BIGINT AS size,
      ('0x' || left(md5('{M.SEED}' || coalesce(':' || doc_id, '')), 8))::BIGINT AS draw FROM {docs}),
  sums AS (SELECT source, sum(size)::HUGEINT AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM sized GROUP BY source),
  weighed AS (SELECT *, {weight}[no % {len(M.WEIGHTS)} + 1]::HUGEINT AS w, {rise[0]}[no % {len(M.SCHEDULES)} + 1] AS a,
      {rise[1]}[no % {len(M.SCHEDULES)} + 1] AS b, {M.MAX_REPEATS} * s AS cap FROM sums),
  cuts AS (SELECT *, coalesce(sum(cap) OVER tight, 0)::HUGEINT AS capped, (sum(w) OVER () - coalesce(sum(w) OVER tight, 0))::HUGEINT AS free,
      sum(s) OVER ()::HUGEINT AS total FROM weighed
    WINDOW tight AS (ORDER BY cap::DOUBLE / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  level AS (SELECT total - capped AS rest, free FROM cuts WHERE w * (total - capped) <= cap * free
    ORDER BY capped, free DESC LIMIT 1),
  targets AS (SELECT *, w * rest > cap * level.free AS over FROM weighed, level),
  quotas AS (SELECT source, s::BIGINT AS source_size, a, b, CASE WHEN over THEN cap::DOUBLE ELSE (w * rest)::DOUBLE / free::DOUBLE END AS target,
      CASE WHEN over THEN cap ELSE (w * rest) // free END::HUGEINT AS quota FROM targets),
  placed AS (SELECT z.*, q.* EXCLUDE (source), coalesce(sum(size) OVER (PARTITION BY z.source ORDER BY draw, doc_id NULLS FIRST, size, rid
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS start
    FROM sized z JOIN quotas q ON z.source IS NOT DISTINCT FROM q.source),
  mixed AS (SELECT doc_id, size, source_size, target, taken, copies,
      CASE WHEN taken > 0 THEN share * (a + b) / (a + sqrt(a * a + (b * b - a * a) * share)) END AS first_position
    FROM (SELECT *, CASE WHEN size > 0 THEN floor(taken::DOUBLE / size::DOUBLE + 0.5) ELSE 0 END::INTEGER AS copies, start::DOUBLE / quota::DOUBLE AS share
      FROM (SELECT *, CASE WHEN source_size > 0 THEN quota // source_size * size
          + least(greatest(quota % source_size - start, 0), size) ELSE 0 END::BIGINT AS taken FROM placed)))"""


OP6 = f"WITH {mixing_sql('documents')} SELECT * FROM mixed"


def near_duplicates_sql(docs: str) -> str:
    """Common table expressions that end in ``classified``: every pair that shares an n-gram is compared."""
    last = J.N - 1
    return f"""classes AS (SELECT md5(text) AS k, min(doc_id) AS text_class, count(*) AS copies, any_value({WORDS}) AS w
      FROM {docs} WHERE doc_id IS NOT NULL AND len({WORDS}) > 0 GROUP BY md5(text)),
  grams AS (SELECT DISTINCT k, CASE WHEN len(w) < {J.N} THEN w ELSE w[i:i + {last}] END AS g
    FROM classes, unnest(generate_series(1, greatest(len(w) - {last}, 1))) AS s(i)),
  sizes AS (SELECT k, count(*) AS n FROM grams GROUP BY k),
  linked AS (SELECT a.k AS a, b.k AS b FROM grams a JOIN grams b ON a.g = b.g AND a.k <> b.k
    JOIN sizes x ON x.k = a.k JOIN sizes y ON y.k = b.k GROUP BY a.k, b.k, x.n, y.n
    HAVING count(*) >= {J.THRESHOLD} * (x.n + y.n - count(*))),
  reach(a, b) AS (SELECT k, k FROM classes UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a),
  component AS (SELECT a AS k, min(text_class) AS class_id FROM reach JOIN classes ON classes.k = reach.b GROUP BY a),
  degree AS (SELECT a AS k, sum(copies) AS n FROM linked JOIN classes ON classes.k = linked.b GROUP BY a),
  classified AS (SELECT d.*, coalesce(text_class, doc_id) AS text_class,
      (CASE WHEN copies IS NULL THEN 0 ELSE copies - 1 + coalesce(degree.n, 0) END)::BIGINT AS n_links,
      coalesce(class_id, doc_id) AS class_id, doc_id IS NULL OR coalesce(class_id, doc_id) = doc_id AS kept
    FROM {docs} d LEFT JOIN classes ON classes.k = md5(d.text) AND d.doc_id IS NOT NULL LEFT JOIN component USING (k) LEFT JOIN degree USING (k))"""


OP8 = f"WITH RECURSIVE {near_duplicates_sql('documents')} SELECT doc_id, text_class, n_links, class_id, kept FROM classified"

OP9 = f"""WITH RECURSIVE valid AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, row_number() OVER () AS rid FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  linked AS (SELECT a.rid AS a, b.rid AS b, b.vec_id FROM valid a JOIN valid b ON a.label = b.label AND a.rid <> b.rid AND len(a.v) = len(b.v)
    WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= {V.THRESHOLD}),
  reach(a, b) AS (SELECT rid, rid FROM valid UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a),
  component AS (SELECT a AS rid, min(vec_id) AS component_id FROM reach JOIN valid ON valid.rid = reach.b GROUP BY a),
  degree AS (SELECT a AS rid, count(*) AS n FROM linked GROUP BY a),
  answer AS (SELECT vec_id, coalesce(n, 0) AS n_links, component_id FROM valid JOIN component USING (rid) LEFT JOIN degree USING (rid)
    UNION ALL SELECT vec_id, 0, vec_id FROM embeddings WHERE vec_id IS NULL OR label IS NULL OR embedding IS NULL OR len(embedding) = 0
      OR len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) > 0 OR len(list_filter(embedding, lambda x: x <> 0)) = 0)
SELECT vec_id, n_links, component_id, vec_id IS NULL OR component_id = vec_id AS kept FROM answer"""


def _host(url: str) -> str:
    rest = f"CASE WHEN contains({url}, '://') THEN substr({url}, strpos({url}, '://') + 3) ELSE '' END"
    return f"translate(regexp_extract({rest}, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _rules_sql() -> tuple[str, str]:
    rule, verdict = "CASE", "CASE"
    for kind, text in sorted(U.RULES, key=lambda r: (-len(r[1]), r[1])):
        name, slash, prefix = text.partition("/")
        fits = f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash + prefix}')"
        rule += f" WHEN {fits} THEN '{text}'"
        verdict += f" WHEN {fits} THEN '{kind}'"
    return rule + " END", verdict + " END"


def url_filters_sql() -> str:
    rule, verdict = _rules_sql()
    keep, rest = U.DAMPING_PERCENT, 100 - U.DAMPING_PERCENT
    rounds = "".join(
        f""",
  r{i + 1} AS MATERIALIZED (SELECT host, sum(trust)::HUGEINT AS trust, sum(distrust)::HUGEINT AS distrust FROM (
      SELECT arcs.dst AS host, (trust * {keep} // 100) * t // n AS trust, (distrust * {keep} // 100) * d // n AS distrust
      FROM arcs JOIN r{i} ON r{i}.host = arcs.src
      UNION ALL SELECT host, trust * {rest} // 100, distrust * {rest} // 100 FROM r0) GROUP BY host)"""
        for i in range(U.ROUNDS)
    )
    share = f"{U.SCALE // 100}::HUGEINT"
    return f"""WITH placed AS (SELECT page_id, html, coalesce({_host('url')}, '') AS host,
      coalesce(regexp_extract(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END, '^[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
  ruled AS (SELECT *, {rule} AS rule, {verdict} AS rule_verdict FROM placed),
  seeds AS (SELECT host, count(*) FILTER (rule_verdict = 'allow') AS allowed, count(*) FILTER (rule_verdict = 'block') AS blocked
    FROM ruled WHERE host <> '' GROUP BY host),
  links AS (SELECT host AS src, unnest(regexp_extract_all(html, '{U.LINK}', 1)) AS link FROM placed),
  parents AS (SELECT host, regexp_extract(host, '^[^.]+[.]([^.]+[.].+)$', 1) AS parent FROM seeds),
  edges AS (SELECT src, dst, count(*) AS weight FROM (
      SELECT src, {_host("CASE WHEN starts_with(link, '//') THEN ':' || link ELSE link END")} AS dst FROM links
      UNION ALL SELECT host, parent FROM parents UNION ALL SELECT parent, host FROM parents)
    WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
  shared AS (SELECT *, sum(weight) OVER (PARTITION BY src) AS o, sum(weight) OVER (PARTITION BY dst) AS b FROM edges),
  arcs AS MATERIALIZED (SELECT src, dst, weight::HUGEINT AS t, 0::HUGEINT AS d, o::HUGEINT AS n FROM shared
    UNION ALL SELECT dst, src, 0, weight, b FROM shared),
  r0 AS MATERIALIZED (SELECT host,
    CASE WHEN sum(allowed) OVER () > 0 THEN {share} * allowed // sum(allowed) OVER () * 100 ELSE 0 END::HUGEINT AS trust,
    CASE WHEN sum(blocked) OVER () > 0 THEN {share} * blocked // sum(blocked) OVER () * 100 ELSE 0 END::HUGEINT AS distrust FROM seeds){rounds}
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict,
  (coalesce(trust, 0) // {U.SCALE // U.REPORTED}::HUGEINT)::BIGINT AS trust, (coalesce(distrust, 0) // {U.SCALE // U.REPORTED}::HUGEINT)::BIGINT AS distrust
FROM ruled LEFT JOIN r{U.ROUNDS} USING (host)"""


OP3 = url_filters_sql()

ORACLES = {"op1_quality_rules": OP1, "op2_line_dedup": OP2, "op3_url_filters": OP3, "op6_mixing": OP6, "op8_ngram_jaccard_join": OP8, "op9_embedding_near_dedup": OP9}
