"""The catalog's queries as plain SQL, for an independent engine (DuckDB dialect)."""

from __future__ import annotations

from ..functions import patterns as P
from ..functions.naming import SOURCE_ROOTS
from ..operators import evaluation as E
from ..operators import generation as G
from . import standins as D
from .catalog import (
    CAP, CHUNK, CUT_LENGTH, CUT_OFF, FIRST_PER_BAND, FIRST_POSITIONS, FIRST_ROWS, GRID_CONFIGURATIONS, LANGUAGE, NO_ID, PAGE_BRANCHES,
    PUSHED_SINCE, PUSHED_TO, ROW_RANGE, SAMPLE_SIZE, SAMPLE_TEST, SAMPLE_TRAIN, SINCE, TO,
)

ORACLES: dict[str, str] = {}


def words(text: str) -> str:
    return f"len(regexp_extract_all({text}, '{P.WORD}'))"


def symbols(text: str) -> str:
    return f"regexp_extract_all({text}, '{P.WORD_OR_SYMBOL}')"


def nloc(text: str) -> str:
    return f"len(list_filter(string_split({text}, chr(10)), lambda l: regexp_matches(l, '{P.NOT_WS}')))"


def spaces(text: str) -> str:
    return f"len(regexp_extract_all({text}, '{P.WS}'))"


COMMAS = "(len(text) - len(replace(text, ',', '')))"
LINES = "(len(text) - len(replace(text, chr(10), '')) + 1)"


def fraction(text: str) -> str:
    """A number in [0, 1) from the md5 of a SQL string."""
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296.0)"


METHODS = f"""methods AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, doc_id AS row_ord, ' ' || upper(source) || ' ' AS repo_name,
    'https://example.org/' || source || '.git' AS repo_url,
    CASE WHEN doc_id % {D.NO_COMMIT} > 0 THEN md5(CAST(doc_id AS VARCHAR)) END AS repo_commit_sha,
    CASE doc_id % 3 WHEN 0 THEN '/src/' WHEN 1 THEN '/src/java/' ELSE '/src/main/java/' END || lang || '\\D.java/' AS file_path,
    regexp_extract(text, '({P.WORD})', 1) AS method_name,
    regexp_extract(text, '({P.WORD})', 1) || '(  args )' AS method_signature,
    doc_id % 50 AS method_start_line,
    CAST(doc_id % 50 + CASE WHEN doc_id % {D.BACKWARDS} > 0 THEN {LINES} - 1 ELSE -1 END AS BIGINT) AS method_end_line,
    text AS method_original_code, {symbols('text')} AS code_tokens,
    CAST(CASE WHEN doc_id % {D.UNPARSED} > 0 THEN 1 + {COMMAS} ELSE 0 END AS BIGINT) AS metrics_cyclomatic_complexity,
    CAST(1 + {nloc('text')} + {words('text')} AS BIGINT) AS metrics_n_ast_nodes,
    CAST({nloc('text')} AS BIGINT) AS metrics_nloc,
    CAST({words('text')} AS BIGINT) AS metrics_n_words,
    CAST({spaces('text')} AS BIGINT) AS metrics_n_whitespaces
  FROM documents)"""
VALID_NAME = f"(NOT regexp_matches(method_name, '{P.NOT_NAME_CHAR}') AND len(method_name) > 1)"
VALID_LINES = "(method_start_line > 0 AND method_end_line >= method_start_line)"
VALID_NLOC = "(metrics_nloc BETWEEN 3 AND 100)"
VALID_PARSE = "(metrics_cyclomatic_complexity > 0)"
STANDARD = f"""{METHODS}, standard AS (
  SELECT * REPLACE (
    lower(regexp_replace(repo_name, '{P.EDGE_WS}', '', 'g')) AS repo_name,
    trim(replace(file_path, '\\', '/'), '/') AS file_path,
    trim(regexp_replace(method_signature, '{P.WS}+', ' ', 'g')) AS method_signature) FROM methods)"""
CLEAN = f"""{STANDARD}, cleaned AS (
  SELECT * FROM standard WHERE {VALID_NAME} AND {VALID_LINES} AND {VALID_NLOC} AND {VALID_PARSE})"""
DEDUPED = f"""{CLEAN}, deduped AS (
  SELECT * FROM cleaned QUALIFY row_number() OVER (
    PARTITION BY repo_name, file_path, method_signature
    ORDER BY repo_commit_sha DESC NULLS FIRST, id DESC) = 1)"""
QUALITY = "metrics_cyclomatic_complexity BETWEEN 2 AND 15 AND metrics_n_ast_nodes > 10"


def sampled(size: int) -> str:
    return f"""{DEDUPED}, good AS (SELECT * FROM deduped WHERE {QUALITY}),
  quotas AS (SELECT repo_name, count(*) AS rows,
      floor({size} * (count(*)::DOUBLE / (SELECT count(*) FROM good))) AS quota
    FROM good WHERE repo_name IS NOT NULL GROUP BY repo_name),
  sampled AS (SELECT id, repo_name FROM good JOIN quotas USING (repo_name)
    WHERE quota > 0 AND quota <= rows
    QUALIFY row_number() OVER (PARTITION BY repo_name ORDER BY md5('42:' || id), id) <= max(quota) OVER (PARTITION BY repo_name))"""


def split(source: str, test_fraction: str) -> str:
    """Largest-remainder stratified split of a table (id, repo_name)."""
    return f"""counts AS (SELECT repo_name, count(*) AS rows FROM {source} GROUP BY repo_name),
  sizes AS (SELECT coalesce(sum(rows) FILTER (rows > 1), 0)::BIGINT AS n,
      least(ceil({test_fraction} * sum(rows)::DOUBLE), coalesce(sum(rows) FILTER (rows > 1), 0))::BIGINT AS n_test FROM counts),
  shares AS (SELECT repo_name, rows, n - n_test AS n_train,
      floor(rows::DOUBLE / n * (n - n_test)) AS base,
      rows::DOUBLE / n * (n - n_test) - floor(rows::DOUBLE / n * (n - n_test)) AS rest
    FROM counts, sizes WHERE rows > 1),
  quota AS (SELECT repo_name, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, repo_name)
        <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS train_rows FROM shares
    UNION ALL SELECT repo_name, rows FROM counts WHERE rows = 1),
  split AS (SELECT id, repo_name, CASE WHEN row_number() OVER (
        PARTITION BY repo_name ORDER BY md5('split:42:' || id), id) <= train_rows THEN 'train' ELSE 'test' END AS dataset_split
    FROM {source} JOIN quota USING (repo_name))"""


TOKENS = f"""rows AS (SELECT doc_id AS row_ord, {symbols('text')} AS code_tokens,
    CAST(1 + {COMMAS} AS BIGINT) AS complexity,
    CASE WHEN substr(md5('42:' || doc_id), 1, 1) IN ('0', '1', '2') THEN 'test' ELSE 'train' END AS dataset_split
  FROM documents)"""


def grams(n: int, name: str, where: str, source: str = "rows", keep: str = "row_ord") -> str:
    """Windows of n tokens as (keep..., pos, ctx, nxt); contexts joined by spaces."""
    columns = keep + ", "
    context = " || ' ' || ".join(
        f"coalesce(lag(nxt, {i}) OVER w, '<START>')" for i in range(n - 1, 0, -1)
    ) or "''"
    return f"""{name} AS (SELECT {columns}pos, {context} AS ctx, nxt FROM (
    SELECT {columns}unnest(list_append(code_tokens, '<END>')) AS nxt,
      unnest(range(1, len(code_tokens) + 2)) AS pos FROM {source} WHERE {where})
    WINDOW w AS (PARTITION BY row_ord ORDER BY pos))"""


def counts(n: int, suffix: str = "") -> str:
    """Counts, totals and the ranked five best continuations of the training rows."""
    s = suffix
    return f"""{grams(n, 'train' + s, "dataset_split = 'train'")},
  counts{s} AS (SELECT ctx, nxt, count(*) AS c, min(row_ord * 2147483648 + pos) AS first_seen FROM train{s} GROUP BY ctx, nxt),
  totals{s} AS (SELECT ctx, sum(c)::BIGINT AS ct FROM counts{s} GROUP BY ctx),
  top{s} AS (SELECT ctx, nxt, c, row_number() OVER (PARTITION BY ctx ORDER BY c DESC, first_seen) AS rank
    FROM counts{s} QUALIFY rank <= 5)"""


VOCABULARY = """vocab AS (SELECT count(DISTINCT t)::BIGINT AS v FROM (
  SELECT unnest(code_tokens || ['<START>', '<END>']) AS t FROM rows WHERE dataset_split = 'train'))"""


def probability(smoothing: str, k: float | None, c: str = "c", ct: str = "ct") -> str:
    if smoothing == "none":
        return f"coalesce({c}::DOUBLE / nullif({ct}, 0), 0)"
    k = 1.0 if smoothing == "laplace" else k
    return f"(({c} + {k}::DOUBLE) / ({ct} + {k}::DOUBLE * v))"


def log_probability(p: str) -> str:
    return f"ln(CASE WHEN {p} > 0 THEN {p} ELSE {E.ZERO_PROBABILITY}::DOUBLE END)"


def head(name: str, source: str, n: int) -> str:
    return f"{name} AS (SELECT * FROM {source} ORDER BY row_ord LIMIT {n})"


TEST = "test AS (SELECT * FROM rows WHERE dataset_split = 'test')"


def looked_up(n: int, source: str, name: str, suffix: str = "") -> str:
    s = suffix
    return f"""{grams(n, 'asked' + name, 'true', source)},
  {name} AS (SELECT a.ctx, a.nxt, a.pos, coalesce(c.c, 0) AS c, coalesce(t.ct, 0) AS ct, coalesce(k.rank, 99) AS rank
    FROM asked{name} a LEFT JOIN counts{s} c ON a.ctx = c.ctx AND a.nxt = c.nxt
    LEFT JOIN totals{s} t ON a.ctx = t.ctx LEFT JOIN top{s} k ON a.ctx = k.ctx AND a.nxt = k.nxt)"""


def within(n: int, positions: int | None) -> str:
    return "true" if positions is None else f"pos <= {positions + 1 - n}"


def accuracy(n: int, names: str, percent: bool = False, positions: int | None = None) -> str:
    """Accuracy columns over looked-up positions of rows with a seen context."""
    return ", ".join(
        f"coalesce(round(count(*) FILTER (ct > 0 AND {within(n, positions)} AND rank <= {k}) / "
        f"nullif(count(*) FILTER (ct > 0 AND {within(n, positions)}), 0){' * 100' if percent else ''}, 6), 0) AS {names.format(k)}"
        for k in ((1, 5) if percent else (1, 3, 5))
    )


def add(name: str, ctes: str, body: str, recursive: bool = False) -> None:
    start = ("WITH RECURSIVE " if recursive else "WITH ") + ctes + " " if ctes else ""
    ORACLES[name] = start + body


# --- sources, sinks -----------------------------------------------------------------------

REPOS = f"""repos AS (SELECT CASE WHEN c_custkey % {D.SHORT_URL} > 0 THEN 'https://example.org/n' || c_nationkey || '/r' || c_custkey || '.git'
    ELSE 'r' || c_custkey END AS clone_url,
  lower(c_mktsegment) AS language, floor(c_acctbal)::BIGINT AS stars, c_custkey % 7 = 0 AS fork,
  DATE '2024-01-01' + (c_custkey % 400)::INTEGER AS pushed_at, c_nationkey, c_custkey FROM customer)"""
CHANGES = """changes AS (SELECT event_id, user_id, ts AS committed_ts,
  'https://example.org/o/r' || user_id % 10 || '.git' AS repo_url,
  md5(user_id || ':' || CAST(ts::DATE AS VARCHAR)) AS commit_sha,
  event_type || CASE WHEN event_type = 'purchase' THEN '.java' ELSE '.md' END AS new_path,
  CASE WHEN event_type <> 'error' THEN props END AS source_code FROM events)"""
PERIOD = f"committed_ts BETWEEN TIMESTAMP '{SINCE}' AND TIMESTAMP '{TO}'"

add("s1_search_repos", REPOS, f"""SELECT clone_url, stars FROM repos WHERE language = '{LANGUAGE}' AND stars > 5000
  AND NOT fork AND pushed_at BETWEEN DATE '{PUSHED_SINCE}' AND DATE '{PUSHED_TO}' ORDER BY stars DESC""")
add("s2_scan_changes", CHANGES, f"""SELECT event_id, commit_sha, new_path FROM changes WHERE {PERIOD}
  AND (repo_url, commit_sha) IN (SELECT (repo_url, commit_sha) FROM changes WHERE {PERIOD} AND new_path LIKE '%.java')""")
add("s2_scan_changes_strict", CHANGES, f"SELECT event_id, new_path FROM changes WHERE {PERIOD} AND new_path LIKE '%.java'")
add("j4_commit_qualification", CHANGES, """SELECT repo_url, commit_sha, count(*) AS files FROM changes
  GROUP BY repo_url, commit_sha HAVING bool_or(new_path LIKE '%.java')""")
add("s5_decode_tokens", TOKENS, """SELECT row_ord, len(code_tokens)::BIGINT AS n_tokens,
  array_to_string(code_tokens, ' ') AS tokens FROM rows""")
add("s6_metric_columns", METHODS, " UNION ALL ".join(
    f"SELECT 'metrics_{m}' AS metric, sum(metrics_{m})::BIGINT AS total FROM methods"
    for m in ("cyclomatic_complexity", "n_ast_nodes", "nloc", "n_words", "n_whitespaces")))
RECORD_ID = "repo_name || '@' || repo_commit_sha[1:7] || ':' || file_path || '#' || method_start_line || '-' || method_end_line"
BELOW_ROOT = "CASE " + " ".join(
    f"WHEN contains(file_path, '{root}') THEN substr(file_path, instr(file_path, '{root}') + {len(root)})" for root in SOURCE_ROOTS
) + " ELSE file_path END"
CLASS_NAME = f"replace(replace({BELOW_ROOT}, '.java', ''), '/', '.')"
EVEN = "len(method_name) % 2 = 0"
add("k1_s3_records_round_trip", METHODS, f"""SELECT {RECORD_ID} AS id, 'example.org--' || regexp_extract(repo_url, '/([^/]*)\\.git$', 1) AS repo_dir,
  ((row_number() OVER (PARTITION BY repo_url ORDER BY {RECORD_ID} NULLS FIRST) - 1) // {CHUNK} + 1)::BIGINT AS chunk,
  replace(repo_url, '.git', '') AS repo_url, method_original_code, len(code_tokens)::BIGINT AS n_tokens,
  metrics_nloc, NULL::VARCHAR AS repo_license FROM methods""")
REASON = f"""CASE WHEN method_start_line % {CUT_OFF[0]} = {CUT_OFF[1]} THEN 'unparseable'
  WHEN method_start_line % {NO_ID[0]} = {NO_ID[1]} OR repo_commit_sha IS NULL THEN 'missing id' ELSE 'ok' END"""
add("s3_f9_read_folders", f"{METHODS}, judged AS (SELECT *, {REASON} AS reason FROM methods)", f"""SELECT reason,
  'example.org--' || regexp_extract(repo_url, '/([^/]*)\\.git$', 1) AS folder, CASE WHEN reason = 'ok' THEN {RECORD_ID} END AS id,
  CASE WHEN reason <> 'unparseable' THEN method_start_line END AS start_line,
  CASE WHEN reason = 'unparseable' THEN {CUT_LENGTH} END AS n_cut FROM judged""")
_STEPS = ("true", VALID_NAME, VALID_LINES, VALID_NLOC, VALID_PARSE)
_STEP_NAMES = ("input", "valid_method_name", "valid_line_span", "nloc_between", "parsed_ok")
add("s3_f9_a4_prepare_reports", f"{STANDARD}, judged AS (SELECT *, {REASON} AS reason FROM standard)",
    "SELECT -2 AS step_no, 'lines read' AS step, count(*) AS rows FROM judged UNION ALL "
    "SELECT -1, 'lines quarantined', count(*) FILTER (reason <> 'ok') FROM judged UNION ALL "
    + " UNION ALL ".join(
        f"SELECT {i}, '{name}', count(*) FROM judged WHERE reason = 'ok' AND {' AND '.join(_STEPS[: i + 1])}"
        for i, name in enumerate(_STEP_NAMES))
    + f" UNION ALL SELECT {len(_STEPS)}, 'deduplicated', count(DISTINCT (repo_name, file_path, method_signature)) FROM judged "
    f"WHERE reason = 'ok' AND {' AND '.join(_STEPS)}")
add("f9_files_without_tree", "", "SELECT CAST(doc_id AS VARCHAR) AS record_id FROM documents WHERE doc_id % 7 = 0 AND lang <> 'de' AND text <> ''")
add("s4_f7_read_split", STANDARD, f"""SELECT id, repo_name, method_name, row_ord FROM standard
  WHERE substr(md5('42:' || id), 1, 1) IN ('0', '1', '2') AND row_ord BETWEEN {ROW_RANGE[0]} AND {ROW_RANGE[1]}""")
add("k2_s4_dataset_round_trip", STANDARD, """SELECT id, repo_name, method_name, method_original_code, '' AS method_doc_comment,
  len(code_tokens)::BIGINT AS n_tokens, metrics_nloc, row_ord FROM standard""")

# --- record shaping -----------------------------------------------------------------------

add("p1_split_repo_url", REPOS, """SELECT clone_url, 'n' || c_nationkey AS owner, 'r' || c_custkey AS repo,
  'n' || c_nationkey || '--r' || c_custkey AS repo_dir FROM repos WHERE clone_url LIKE '%/%'""")
add("p2_clean_repo_url", REPOS, "SELECT clone_url, replace(clone_url, '.git', '') AS url FROM repos")
add("p3_qualified_class_name", METHODS, f"SELECT id, {CLASS_NAME} AS class_name FROM methods")
add("p4_record_id", METHODS, f"SELECT id, {RECORD_ID} AS record_id FROM methods")
add("p5_method_qualified_name", METHODS, f"SELECT id, {CLASS_NAME} || '#' || method_name AS qualified_name FROM methods")
add("p6_build_record", METHODS, f"""SELECT {RECORD_ID} AS id, 'train' AS dataset_split, replace(repo_url, '.git', '') AS repo_url,
  'Java' AS language, {CLASS_NAME} || '#' || method_name AS qualified_name, method_signature AS signature,
  len(code_tokens)::BIGINT AS token_counts, metrics_nloc AS nloc, len(code_tokens)::BIGINT AS n_tokens FROM methods""")
SHAPED = f"""shaped AS (SELECT *, CASE WHEN {EVEN} THEN metrics_n_whitespaces ELSE 0 END AS ws,
  CASE WHEN {EVEN} THEN metrics_n_words ELSE 0 END AS words,
  len(list_distinct(code_tokens))::BIGINT AS vocab_size, len(code_tokens)::BIGINT AS token_counts FROM methods)"""
add("p7_coalesce_metric_shape", f"{METHODS}, {SHAPED}", """SELECT repo_commit_sha AS commit_sha, ws AS n_whitespaces, words AS n_words,
  metrics_nloc AS nloc, token_counts, vocab_size FROM shaped""")
add("p8_flatten_one_level", f"{METHODS}, {SHAPED}", f"""SELECT 'train' AS dataset_split, {RECORD_ID} AS id, repo_name,
  replace(repo_url, '.git', '') AS repo_url, repo_commit_sha, NULL::VARCHAR AS repo_license, file_path, 'Java' AS file_language,
  method_name, {CLASS_NAME} || '#' || method_name AS method_qualified_name, method_start_line, method_end_line, method_signature,
  '' AS method_doc_comment, array_to_string(code_tokens, ' ') AS code_tokens, metrics_cyclomatic_complexity, metrics_n_ast_nodes,
  3::BIGINT AS metrics_ast_depth, metrics_n_words AS metrics_n_identifiers, vocab_size AS metrics_vocab_size,
  ws AS metrics_n_whitespaces, words AS metrics_n_words, metrics_nloc, token_counts AS metrics_token_counts FROM shaped""")
add("p9_drop_license", METHODS, "SELECT id, repo_url FROM methods")
add("p10_p12_standardize", STANDARD, "SELECT id, repo_name, file_path, method_signature FROM standard")
BAND = """CASE WHEN {0} <= 0 THEN NULL WHEN {0} <= 2 THEN 'Low (1-2)' WHEN {0} <= 5 THEN 'Medium (3-5)'
  WHEN {0} <= 10 THEN 'High (6-10)' WHEN {0} > 10 THEN 'Very High (>10)' END"""
add("p13_complexity_band", METHODS, f"SELECT id, {BAND.format('metrics_cyclomatic_complexity')} AS complexity FROM methods")

# --- filters ------------------------------------------------------------------------------

add("f1_has_source", CHANGES, "SELECT event_id, source_code FROM changes WHERE source_code IS NOT NULL AND source_code <> ''")
add("f2_valid_method_name", METHODS, f"SELECT id, method_name FROM methods WHERE {VALID_NAME}")
add("f3_valid_line_span", METHODS, f"SELECT id, method_start_line, method_end_line FROM methods WHERE {VALID_LINES}")
add("f4_nloc_between", METHODS, f"SELECT id, metrics_nloc FROM methods WHERE {VALID_NLOC}")
add("f5_parsed_ok", METHODS, f"SELECT id, metrics_cyclomatic_complexity FROM methods WHERE {VALID_PARSE}")
add("f6_quality_filter", METHODS, f"SELECT id, metrics_cyclomatic_complexity, metrics_n_ast_nodes FROM methods WHERE {QUALITY}")
add("f7_select_split", TOKENS, "SELECT row_ord, dataset_split FROM rows WHERE dataset_split = 'test'")
add("f8_min_prompt_length", TOKENS, "SELECT row_ord, len(code_tokens)::BIGINT AS n_tokens FROM rows WHERE len(code_tokens) > 3")
add("f9_isolate_bad_rows", CHANGES, """SELECT event_id, CASE WHEN source_code IS NULL THEN 'missing source_code'
  WHEN TRY_CAST(regexp_extract(source_code, '^\\{"k": (-?[0-9]+)\\}$', 1) AS BIGINT) IS NULL THEN 'missing parsed' ELSE 'ok' END AS bad_reason FROM changes""")
add("clean_methods", CLEAN, "SELECT id, repo_name, file_path, method_signature FROM cleaned")

# --- joins --------------------------------------------------------------------------------

add("j1_attach_license", REPOS, """SELECT clone_url AS repo_url, lower(n_name) AS license_key
  FROM repos LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey AND clone_url LIKE '%/%'""")

# --- aggregations over trees and methods --------------------------------------------------


def node_lines(branching: bool) -> str:
    second = f"{symbols('line')}[2]"
    kind = f"CASE WHEN {words('line')} < 5 THEN 'comment' ELSE 'method_declaration' END"
    if branching:
        kind = f"CASE WHEN {second} IN (',', '.') THEN 'binary_expression' WHEN contains(line, ',') THEN 'if_statement' ELSE {kind} END"
    return f"""lines AS (SELECT *, {kind} AS kind FROM (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS row FROM documents)
    WHERE regexp_matches(line, '{P.NOT_WS}')),
  leaves AS (SELECT doc_id, row, kind, unnest({symbols('line')}) AS token, unnest(range(len({symbols('line')}))) AS pos FROM lines)"""


LEAVES = node_lines(False)
# A document without tokens is a tree of one node, which is then a leaf itself.
TREE_METRICS = f"""tree AS (SELECT doc_id, 1 + coalesce(l.n, 0) + coalesce(t.n, 0) AS n_ast_nodes,
    CASE WHEN t.n > 0 THEN 3 ELSE 1 END AS ast_depth, coalesce(t.words, 0) AS n_identifiers,
    coalesce(t.distinct_tokens, 1) AS vocab_size, coalesce(t.n, 1) AS token_counts
  FROM documents LEFT JOIN (SELECT doc_id, count(*) AS n FROM lines GROUP BY doc_id) l USING (doc_id)
  LEFT JOIN (SELECT doc_id, count(*) AS n, count(DISTINCT token) AS distinct_tokens,
    count(DISTINCT token) FILTER (regexp_matches(token, '{P.WORD}')) AS words FROM leaves GROUP BY doc_id) t USING (doc_id))"""
TREE_COLUMNS = ", ".join(f"{c}::BIGINT AS {c}" for c in ("n_ast_nodes", "ast_depth", "n_identifiers", "vocab_size", "token_counts"))
COMPLEXITY = f"""ops AS (SELECT doc_id, row, count(*) AS children, max(CASE WHEN pos = 1 THEN token END) AS op FROM leaves
    WHERE kind = 'binary_expression' GROUP BY doc_id, row),
  complexity AS (SELECT doc_id, CASE WHEN NOT regexp_matches(text, '{P.NOT_WS}') THEN 0 ELSE 1
    + coalesce((SELECT count(*) FROM lines l WHERE l.doc_id = d.doc_id AND kind = 'if_statement'), 0)
    + coalesce((SELECT count(*) FROM ops o WHERE o.doc_id = d.doc_id AND children >= 3 AND op IN (',', '.')), 0) END AS cyclomatic_complexity
  FROM documents d)"""
add("a1_tree_metrics", f"{LEAVES}, {TREE_METRICS}", f"SELECT CAST(doc_id AS VARCHAR) AS record_id, {TREE_COLUMNS} FROM tree")
add("a2_leaf_tokens", LEAVES, """SELECT CAST(doc_id AS VARCHAR) AS record_id, coalesce(string_agg(token, ' ' ORDER BY row, pos), any_value(text)) AS code_tokens
  FROM documents LEFT JOIN leaves USING (doc_id) GROUP BY doc_id""")
BRANCHING = node_lines(True)
add("a3_branch_complexity", f"{BRANCHING}, {COMPLEXITY}",
    "SELECT CAST(doc_id AS VARCHAR) AS record_id, cyclomatic_complexity::BIGINT AS cyclomatic_complexity FROM complexity")
# With operators renamed, a full stop and a comma stay two different texts: counts do not change.
add("x5_all_metrics", f"{BRANCHING}, {TREE_METRICS}, {COMPLEXITY}", f"""SELECT CAST(doc_id AS VARCHAR) AS record_id,
  {spaces('text')}::BIGINT AS n_whitespaces, {words('text')}::BIGINT AS n_words, {nloc('text')}::BIGINT AS nloc,
  {TREE_COLUMNS}, cyclomatic_complexity::BIGINT AS cyclomatic_complexity
  FROM documents JOIN tree USING (doc_id) JOIN complexity USING (doc_id)""")
add("x1_x4_text_metrics", "", f"""SELECT doc_id, {spaces('text')}::BIGINT AS n_whitespaces,
  {words('text')}::BIGINT AS n_words, {nloc('text')}::BIGINT AS nloc FROM documents""")
add("d1_extract_declarations", f"""{LEAVES}, commas AS (SELECT doc_id, row, max(pos) AS last FROM leaves WHERE token = ',' GROUP BY doc_id, row),
  named AS (SELECT doc_id, row, max_by(token, pos) AS name, max_by(token, pos) FILTER (pos < last) AS earlier FROM leaves
    LEFT JOIN commas USING (doc_id, row) WHERE regexp_matches(token, '{P.WORD}') GROUP BY doc_id, row)""",
    """SELECT CAST(doc_id AS VARCHAR) AS record_id, (row + 1) * 4294967296 AS node_id, coalesce(name, 'unknown') AS name,
  CASE WHEN last IS NULL THEN 'unknown' ELSE coalesce(earlier, 'unknown') || ',' END AS signature, line AS source_code,
  row + 1 AS start_line, row + 1 AS end_line
  FROM lines LEFT JOIN named USING (doc_id, row) LEFT JOIN commas USING (doc_id, row) WHERE kind = 'method_declaration'""")
add("d2_leading_comment", f"""{LEAVES}, before AS (SELECT *, lag(kind) OVER w AS prev_kind, lag(line) OVER w AS prev FROM lines
  WINDOW w AS (PARTITION BY doc_id ORDER BY row))""",
    f"""SELECT CAST(doc_id AS VARCHAR) AS record_id, (row + 1) * 4294967296 AS node_id,
  CASE WHEN prev_kind = 'comment' THEN regexp_replace(prev, '{P.EDGE_WS}', '', 'g') ELSE '' END AS doc_comment
  FROM before WHERE kind = 'method_declaration'""")

VOID = ", ".join(f"'{t}'" for t in D.NEVER_CLOSED)
# A node is a leaf when the node after it is not one level deeper.
PAGES = f"""parts AS (SELECT page_id, unnest(regexp_extract_all(html, '{D.TAG_OR_TEXT}')) AS part,
    unnest(range(len(regexp_extract_all(html, '{D.TAG_OR_TEXT}')))) AS pos FROM pages),
  tagged AS (SELECT *, regexp_extract(part, '^<([a-zA-Z0-9]+)', 1) AS tag FROM parts),
  levels AS (SELECT *, 2 + greatest(0, coalesce(sum(CASE WHEN tag <> '' AND tag NOT IN ({VOID}) AND NOT regexp_matches(part, '{D.CLOSED}') THEN 1 WHEN part LIKE '</%' THEN -1 ELSE 0 END)
    OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS depth FROM tagged),
  nodes AS (SELECT *, coalesce(lead(depth) OVER (PARTITION BY page_id ORDER BY pos), 0) <= depth AS leaf FROM levels WHERE part NOT LIKE '</%')"""
add("a1_tree_metrics_pages", PAGES, """SELECT CAST(page_id AS VARCHAR) AS record_id, (1 + count(*))::BIGINT AS n_ast_nodes, max(depth)::BIGINT AS ast_depth,
  count(DISTINCT part) FILTER (part NOT LIKE '<%') AS n_identifiers, count(DISTINCT part) FILTER (leaf) AS vocab_size,
  count(*) FILTER (leaf) AS token_counts FROM nodes GROUP BY page_id""")
add("a2_leaf_tokens_pages", PAGES, """SELECT CAST(page_id AS VARCHAR) AS record_id, string_agg(part, ' ' ORDER BY depth, pos) FILTER (leaf) AS code_tokens
  FROM nodes GROUP BY page_id""")
_BRANCHES = ", ".join(f"'{t}'" for t in PAGE_BRANCHES)
add("a3_branch_complexity_pages", PAGES, f"""SELECT CAST(page_id AS VARCHAR) AS record_id,
  1 + count(*) FILTER (tag IN ({_BRANCHES})) AS cyclomatic_complexity FROM nodes GROUP BY page_id""")

_STEPS = ["true", VALID_NAME, VALID_LINES, VALID_NLOC, VALID_PARSE]
_NAMES = ["input", "valid_method_name", "valid_line_span", "nloc_between", "parsed_ok"]
add("a4_step_report", DEDUPED, " UNION ALL ".join(
    [f"SELECT {i}::BIGINT AS step_no, '{name}' AS step, count(*) FILTER ({' AND '.join(_STEPS[: i + 1])}) AS rows FROM standard"
     for i, name in enumerate(_NAMES)]
    + ["SELECT 5::BIGINT AS step_no, 'deduplicated' AS step, count(*) AS rows FROM deduped"]))
add("w1_duplicate_report", CLEAN, """SELECT id, repo_name, file_path, method_signature FROM cleaned
  QUALIFY count(*) OVER (PARTITION BY repo_name, file_path, method_signature) > 1""")
add("w2_dedupe_keep_last", DEDUPED, "SELECT id, repo_name, file_path, method_signature, repo_commit_sha FROM deduped")
add("a5_distinct_repos", DEDUPED, "SELECT count(DISTINCT repo_name) AS repos FROM deduped")
add("a6_repo_distribution", DEDUPED, "SELECT repo_name, count(*) AS rows FROM deduped WHERE repo_name IS NOT NULL GROUP BY repo_name")
add("a8_mining_report", CHANGES, f"""SELECT repo_url, count(*) AS methods,
  CASE WHEN grouping(repo_url) = 0 THEN (count(*) - 1) // {CHUNK} + 1 END AS chunks, grouping(repo_url)::BIGINT AS is_total
  FROM changes GROUP BY ROLLUP (repo_url)""")
add("w3_chunk_number", CHANGES, f"""SELECT event_id, repo_url,
  (row_number() OVER (PARTITION BY repo_url ORDER BY committed_ts, event_id) - 1) // {CHUNK} + 1 AS chunk FROM changes""")
add("w4_mining_cap", CHANGES, f"""SELECT event_id, repo_url FROM changes WHERE source_code <> ''
  ORDER BY repo_url, committed_ts, event_id LIMIT {CAP}""")

# --- sampling and splitting ---------------------------------------------------------------

add("w5_u1_proportional_sample", sampled(SAMPLE_SIZE), "SELECT id, repo_name FROM sampled")
add("w5_shortfall_all", DEDUPED, f"SELECT id, repo_name FROM deduped WHERE {QUALITY}")
add("t4_shuffle", METHODS, "SELECT id, repo_name FROM methods ORDER BY md5('42:' || id), id")
add("r1_stratified_split", f"{STANDARD}, {split('standard', '0.2::DOUBLE')}", "SELECT id, repo_name, dataset_split FROM split")
ROW_ORD = "row_number() OVER (ORDER BY dataset_split = 'test', md5('42:' || id), id) - 1 AS row_ord"
add("u2_union_splits", TOKENS, f"SELECT id, dataset_split, {ROW_ORD} FROM (SELECT CAST(row_ord AS VARCHAR) AS id, dataset_split FROM rows)")
FRACTION = f"({SAMPLE_TEST} / {SAMPLE_TEST + SAMPLE_TRAIN})::DOUBLE"
add("r2_sample_from_large_repos", f"{sampled(SAMPLE_SIZE)}, {split('sampled', FRACTION)}",
    f"SELECT id, repo_name, dataset_split, {ROW_ORD} FROM split")
add("a7_split_report", f"{STANDARD}, {split('standard', '0.2::DOUBLE')}", """SELECT repo_name, count(*) FILTER (dataset_split = 'train') AS train_rows,
  count(*) FILTER (dataset_split = 'test') AS test_rows FROM split GROUP BY repo_name""")

# --- n-gram model -------------------------------------------------------------------------

add("n2_pad", TOKENS, "SELECT row_ord, '<START> <START> ' || array_to_string(code_tokens || ['<END>'], ' ') AS padded FROM rows")
add("n1_extract_ngrams", f"{TOKENS}, {grams(3, 'windows', 'true')}", "SELECT row_ord, 3::BIGINT AS n, ctx, nxt, pos::BIGINT AS pos FROM windows")
for _n in (1, 3):
    add(f"a9_ngram_counts_n{_n}", f"{TOKENS}, {counts(_n)}", f"SELECT {_n}::BIGINT AS n, ctx, nxt, c, first_seen::BIGINT AS first_seen FROM counts")
add("a10_context_totals_n5", f"{TOKENS}, {counts(5)}", "SELECT 5::BIGINT AS n, ctx, ct FROM totals")
add("a11_vocabulary_size", f"{TOKENS}, {VOCABULARY}", "SELECT v FROM vocab")
add("t3_next_token_topk", f"{TOKENS}, {counts(3)}", "SELECT 3::BIGINT AS n, ctx, rank, nxt, c FROM top")
add("n4_fit_context", TOKENS, """SELECT row_ord, array_to_string(list_transform(range(10 - least(len(code_tokens), 10)), lambda i: '<START>')
  || code_tokens[greatest(len(code_tokens) - 9, 1):], ' ') AS ctx FROM rows""")
add("n10_train", f"{TOKENS}, {counts(3)}, {VOCABULARY}", """SELECT count(*) AS pairs, count(DISTINCT ctx) AS contexts,
  sum(c)::BIGINT AS occurrences, any_value(v) AS v FROM counts, vocab""")
add("n10_a11_train_in_batches", f"{TOKENS}, {counts(3)}, {VOCABULARY}", """SELECT count(*) AS pairs, sum(c)::BIGINT AS occurrences,
  CAST(sum(first_seen) AS VARCHAR) AS first_seen_sum, any_value(v) AS v, true AS sketch_is_close FROM counts, vocab""")
add("j2_n3_score", f"{TOKENS}, {TEST}, {counts(3)}, {VOCABULARY}, {looked_up(3, 'test', 'found')}",
    f"""SELECT DISTINCT ctx, nxt, c, ct, round({probability('none', None)}, 6) AS p_none,
  round({probability('laplace', None)}, 6) AS p_laplace, round({probability('add-k', 0.1)}, 6) AS p_add_k FROM found, vocab""")
add("j3_lookup_topk", f"{TOKENS}, {TEST}, {counts(5)}, {grams(5, 'asked', 'true', 'test')}",
    """SELECT ctx, string_agg(nxt, ' ' ORDER BY rank) AS tokens FROM top WHERE ctx IN (SELECT ctx FROM asked) GROUP BY ctx""")


def perplexity(smoothing: str, k: float | None, where: str = "true") -> str:
    return f"round(exp(-avg({log_probability(probability(smoothing, k))}) FILTER ({where})), 4)"


for _name, _n, _smoothing in (("a12_perplexity_n3", 3, "laplace"), ("a12_perplexity_n5_none", 5, "none")):
    add(_name, f"{TOKENS}, {TEST}, {counts(_n)}, {VOCABULARY}, {looked_up(_n, 'test', 'found')}",
        f"SELECT {perplexity(_smoothing, None)} AS perplexity, count(*) AS positions FROM found, vocab")


def accuracy_query(name: str, n: int, rows: int | None, positions: int | None = None) -> None:
    source = "test" if rows is None else "first_rows"
    heads = "" if rows is None else f"{head('first_rows', 'test', rows)}, "
    hits = ", ".join(f"count(*) FILTER (ct > 0 AND {within(n, positions)} AND rank <= {k}) AS top{k}_hits" for k in (1, 3, 5))
    add(name, f"{TOKENS}, {TEST}, {heads}{counts(n)}, {looked_up(n, source, 'found')}",
        f"SELECT {accuracy(n, 'top{}_accuracy', positions=positions)}, {hits}, count(*) FILTER (ct > 0 AND {within(n, positions)}) AS total_predictions FROM found")


accuracy_query("a13_topk_accuracy_n3", 3, None)
accuracy_query("a13_topk_accuracy_n5", 5, None)
accuracy_query("a13_topk_accuracy_first", 5, FIRST_ROWS, FIRST_POSITIONS)
accuracy_query("a17_large_scale_eval", 11, None)
accuracy_query("a17_large_scale_first", 11, FIRST_ROWS, FIRST_POSITIONS)
for _name, _first, _positions in (("a14_accuracy_by_complexity", None, None), ("a14_accuracy_first", FIRST_PER_BAND, FIRST_POSITIONS)):
    _banded = f"""banded AS (SELECT *, {BAND.format('complexity')} AS band FROM test WHERE complexity > 0
  {f'QUALIFY row_number() OVER (PARTITION BY band ORDER BY row_ord) <= {_first}' if _first else ''})"""
    add(_name, f"{TOKENS}, {TEST}, {_banded}, {counts(5)}, {grams(5, 'asked', 'true', 'banded', 'row_ord, band')}",
        f"""SELECT band AS complexity, count(DISTINCT row_ord) AS samples, {accuracy(5, 'top{}_acc', percent=True, positions=_positions)}
  FROM (SELECT a.*, coalesce(t.ct, 0) AS ct, coalesce(k.rank, 99) AS rank FROM asked a LEFT JOIN totals t USING (ctx)
    LEFT JOIN top k ON a.ctx = k.ctx AND a.nxt = k.nxt) GROUP BY band""")



def grid_sql(rows: int | None, positions: int | None) -> str:
    source = "test" if rows is None else "first_rows"
    heads = "" if rows is None else f"{head('first_rows', 'test', rows)}, "
    sizes = sorted({c.n for c in GRID_CONFIGURATIONS})
    tables = ", ".join(f"{counts(n, f'_{n}')}, {looked_up(n, source, f'found{n}', f'_{n}')}" for n in sizes)
    # Without a context there is no start sentinel in the vocabulary.
    known = {n: "(SELECT v - 1 AS v FROM vocab)" if n == 1 else "vocab" for n in sizes}
    cells = " UNION ALL ".join(
        f"""SELECT {i}::BIGINT AS config_ord, {c.n}::BIGINT AS n, '{c.smoothing}' AS smoothing, {c.k if c.k else 'NULL'}::DOUBLE AS k,
    (SELECT {perplexity(c.smoothing, c.k)} FROM found{c.n}, {known[c.n]} known) AS perplexity, a.* FROM
    (SELECT {accuracy(c.n, 'top{}_acc', positions=positions)}, count(*) FILTER (ct > 0 AND {within(c.n, positions)}) AS total_predictions FROM found{c.n}) a"""
        for i, c in enumerate(GRID_CONFIGURATIONS)
    )
    return f"{TOKENS}, {TEST}, {VOCABULARY}, {heads}{tables}, grid AS ({cells})"


GRID = grid_sql(None, None)
add("a15_score_grid", GRID, "SELECT * FROM grid")
add("a15_score_grid_first", grid_sql(FIRST_ROWS, FIRST_POSITIONS), "SELECT * FROM grid")
_BEST = "SELECT '{0}' AS criterion, config_ord, n, smoothing, k, perplexity, top1_acc, top3_acc, top5_acc, CASE WHEN smoothing = 'add-k' THEN 0.1 ELSE 1.0 END::DOUBLE AS model_k FROM (SELECT * FROM grid ORDER BY {1}, config_ord LIMIT 1)"
add("a16_best_configs", GRID, _BEST.format("lowest_perplexity", "perplexity") + " UNION ALL " + _BEST.format("highest_accuracy", "top1_acc DESC"))
add("k3_write_results", GRID, """SELECT n, smoothing, coalesce(CAST(k AS VARCHAR), '-') AS k, perplexity, top1_acc, top3_acc, top5_acc FROM grid""")
add("t2_head_n", f"{TOKENS}, {TEST}", f"SELECT row_ord FROM test ORDER BY row_ord LIMIT {FIRST_ROWS}")
add("w6_head_per_group", f"{TOKENS}, {TEST}", f"""SELECT row_ord, {BAND.format('complexity')} AS complexity FROM test
  QUALIFY row_number() OVER (PARTITION BY {BAND.format('complexity')} ORDER BY row_ord) <= {FIRST_PER_BAND}""")

# --- generation ---------------------------------------------------------------------------

PROMPTS = f"""{TOKENS}, {TEST}, prompts AS (
  SELECT row_ord, code_tokens[1:3 + floor({fraction("'42:prompt:' || row_ord")} * (least(10, len(code_tokens) - 1) - 2))::BIGINT] AS context
  FROM test WHERE len(code_tokens) > 3)"""
# The five best continuations of every context as lists, under laplace smoothing.
OFFERED = f"""{counts(5)}, {VOCABULARY}, offered AS (
  SELECT ctx, list(nxt ORDER BY rank) AS tokens, list({probability('laplace', None)} ORDER BY rank) AS probs
  FROM top JOIN totals USING (ctx), vocab GROUP BY ctx)"""
TRIES = """array_to_string(list_transform(range(4 - kept), lambda i: '<START>') || context[len(context) - kept + 1:], ' ')"""
BACKED_OFF = f"""tries AS (SELECT row_ord, context, least(len(context), 4) - kept AS level, {TRIES} AS ctx
    FROM (SELECT *, unnest(range(1, least(len(context), 4) + 1)) AS kept FROM prompts)),
  backed_off AS (SELECT t.*, tokens, probs FROM tries t JOIN offered USING (ctx)
    QUALIFY row_number() OVER (PARTITION BY row_ord ORDER BY level) = 1)"""
# The first running sum of the probabilities above a share of their sum.
PICK = """tokens[least(1 + len(list_filter(range(1, len(probs) + 1), lambda i: list_sum(probs[1:i]) <= {draw} * list_sum(probs))), len(tokens))]"""

add("n6_make_prompts", PROMPTS, "SELECT row_ord, array_to_string(context, ' ') AS context FROM prompts")
FORMATTED = "coalesce(array_to_string(list_transform(range(1, len(tokens) + 1), lambda i: format('{{}} ({{:.3f}})', tokens[i], probs[i])), ', '), '')".replace("{{", "{").replace("}}", "}")
FITTED = "SELECT row_ord, context, array_to_string(list_transform(range(4 - least(len(context), 4)), lambda i: '<START>') || context[greatest(len(context) - 3, 1):], ' ') AS ctx FROM prompts"
add("n5_p14_predict_next", f"{PROMPTS}, {OFFERED}", f"""SELECT row_ord, array_to_string(context, ' ') AS context,
  coalesce(len(tokens), 0)::BIGINT AS n_candidates, {FORMATTED} AS formatted FROM ({FITTED}) LEFT JOIN offered USING (ctx)""")
add("n7_backoff_candidates", f"{PROMPTS}, {OFFERED}, {BACKED_OFF}", """SELECT row_ord, level::BIGINT AS level, array_to_string(tokens, ' ') AS tokens
  FROM prompts LEFT JOIN backed_off USING (row_ord)""")
add("n8_sample_next", f"{PROMPTS}, {OFFERED}, {BACKED_OFF}", f"""SELECT row_ord, {PICK.format(draw=fraction("'42:step:0:' || row_ord"))} AS token
  FROM prompts LEFT JOIN backed_off USING (row_ord)""")

_FIT = """array_to_string(list_transform(range(4 - least(len(context), {0})), lambda i: '<START>')
      || context[len(context) - least(len(context), {0}) + 1:], ' ')"""
_OFFERS = ", ".join(f"o{i}.{{0}}" for i in (4, 3, 2, 1))
_LOOKUPS = " ".join(f"LEFT JOIN offered o{i} ON o{i}.ctx = {_FIT.format(i)}" for i in (4, 3, 2, 1))
_STOPS = ", ".join(f"'{t}'" for t in G.STOP_TOKENS)
COMPLETED = f"""walk AS (
    SELECT row_ord, 0 AS step, context, []::VARCHAR[] AS generated, true AS active FROM prompts
  UNION ALL
    SELECT row_ord, step + 1, CASE WHEN goes_on THEN list_append(context, token)[greatest(len(context) - 2, 1):] ELSE context END,
      CASE WHEN emitted THEN list_append(generated, token) ELSE generated END, goes_on
    FROM (SELECT *, emitted AND token NOT IN ({_STOPS}) AS goes_on FROM (
      SELECT *, token <> '<END>' AS emitted FROM (
        SELECT *, {PICK.format(draw=fraction("'42:step:' || step || ':' || row_ord"))} AS token FROM (
          SELECT w.*, coalesce({_OFFERS.format('tokens')}) AS tokens, coalesce({_OFFERS.format('probs')}) AS probs
          FROM walk w {_LOOKUPS} WHERE w.active AND w.step < {G.MAX_COMPLETION}))
      WHERE tokens IS NOT NULL))),
  completed AS (SELECT row_ord, max(step) AS n_steps, max_by(generated, step) AS completion FROM walk GROUP BY row_ord)"""
# Candidates are computed once, not at every level of the recursion.
WALK = f"{PROMPTS}, {OFFERED.replace('offered AS (', 'offered AS MATERIALIZED (')}, {COMPLETED}"
add("n9_complete", WALK, """SELECT row_ord, array_to_string(p.context, ' ') AS context, array_to_string(completion, ' ') AS completion,
  n_steps::BIGINT AS n_steps FROM prompts p JOIN completed USING (row_ord)""", recursive=True)
_PREDICTED = f"""array_to_string(context, ' ') AS input_context, {FORMATTED} AS "next_5_tokens (probability)",
  array_to_string(context, ' ') || ' ' || array_to_string(completion, ' ') AS sampled_completion
  FROM ({FITTED}) LEFT JOIN offered USING (ctx) JOIN completed USING (row_ord)"""
add("p15_prediction_rows", WALK, f"SELECT row_ord, {_PREDICTED}", recursive=True)
add("k4_write_predictions", WALK, f"SELECT {_PREDICTED}", recursive=True)
