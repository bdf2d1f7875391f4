"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on views named after the driver tables and must return the
same rows and column names as the Spark query of the same name.
"""

from __future__ import annotations

from .. import fixed
from ..functions.text import sql_whitespace_literal

WS = sql_whitespace_literal()
NL = "chr(10)"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def cl(x: str) -> str:
    """clean(): null → '', Unicode whitespace trimmed."""
    return f"trim(coalesce({x}, ''), {WS})"


def first_line(x: str) -> str:
    return f"split_part({x}, {NL}, 1)"


def any_of(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, {lit(w)})" for w in words) + ")"


def order_hash(key: str, seed: int = fixed.SEED) -> str:
    return f"md5({lit(str(seed) + ':')} || CAST({key} AS VARCHAR))"


# Keyword lists used by the registered chat queries: the driver tables hold
# prose, not code, so the reference lists would match nothing there.
REVIEW_QUERY_KEYWORDS = ("the ", "und ")
OPT_QUERY_GROUPS = (("the ", " la ", " der "), ("tion", "ung", "ent"))
SECURITY_QUERY_LANGS = ("en", "de")
SAMPLE_N = 100
ROLE_FILE_IDS = 500
EVENT_FILE_LINES = 1000
VOCAB_MIN_COUNT = 2


def code_writer_sql() -> str:
    return f"""
      SELECT id, instruction, input, output FROM (
        SELECT doc_id AS id, {cl(first_line('text'))} AS instruction, {cl('source')} AS input,
               {cl('text')} AS output
        FROM documents)
      WHERE instruction <> '' AND output <> '' AND length(output) >= {fixed.MIN_OUTPUT_CHARS}"""


def test_capped_sql() -> str:
    return f"""
      SELECT id, {lit(fixed.TEST_GENERATOR_INSTRUCTION)} AS instruction,
             {lit(fixed.PROBLEM_HEADING)} || question || {lit(fixed.IMPLEMENTATION_HEADING)}
               || truth || {lit(fixed.CODE_CLOSE)} AS input,
             array_to_string(kept, {NL} || {NL}) AS output
      FROM (
        SELECT *, list_filter(list_transform(list_slice(tests, 1, {fixed.MAX_UNIT_TESTS}), lambda x: {cl('x')}),
                              lambda x: x <> '') AS kept
        FROM (SELECT doc_id AS id, {cl(first_line('text'))} AS question, {cl('text')} AS truth,
                     coalesce(string_split(text, {NL}), []) AS tests FROM documents)
        WHERE question <> '' AND truth <> '' AND len(tests) > 0)
      WHERE len(kept) > 0"""


def test_joined_sql() -> str:
    return f"""
      SELECT id, {lit(fixed.TEST_GENERATOR_FALLBACK_INSTRUCTION)} AS instruction,
             {lit(fixed.TASK_HEADING)} || text || {lit(fixed.IMPLEMENTATION_HEADING)}
               || code || {lit(fixed.CODE_CLOSE)} AS input,
             array_to_string(tests, {NL}) AS output
      FROM (SELECT doc_id AS id, {cl(first_line('text'))} AS text, {cl('text')} AS code,
                   coalesce(string_split(text, {NL}), []) AS tests FROM documents)
      WHERE text <> '' AND code <> '' AND len(tests) > 0"""


def renamed_turns_sql() -> str:
    return """
      SELECT conv_id, turn,
             CASE WHEN role = 'user' AND (conv_id + turn) % 3 = 0 THEN 'human'
                  WHEN role = 'assistant' AND (conv_id + turn) % 5 = 0 THEN 'tool'
                  ELSE role END AS role,
             text
      FROM conversations"""


def norm_role(r: str) -> str:
    return (
        f"CASE WHEN {r} IS NULL THEN 'user' WHEN {r} IN ('user','assistant','system') THEN {r} "
        f"WHEN {r} = 'human' THEN 'user' ELSE 'assistant' END"
    )


def review_sql(keywords=REVIEW_QUERY_KEYWORDS) -> str:
    """Cleaned chats as (id, n_messages, roles, transcript)."""
    return f"""
      WITH t AS ({renamed_turns_sql()}),
      conv AS (SELECT conv_id AS id, count(*) AS n_raw,
                      string_agg(lower(substr(coalesce(text, ''), 1, {fixed.KEYWORD_WINDOW})), ' ' ORDER BY turn) AS win
               FROM t GROUP BY conv_id),
      keep AS (SELECT id FROM conv WHERE n_raw >= {fixed.MIN_TURNS} AND {any_of('win', keywords)}),
      cm AS (SELECT conv_id AS id, turn, {norm_role('role')} AS role, {cl('text')} AS content FROM t),
      agg AS (SELECT id, count(*) AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles,
                     string_agg('<|' || role || '|>' || {NL} || content, {NL} ORDER BY turn) AS transcript
              FROM cm WHERE content <> '' AND id IN (SELECT id FROM keep) GROUP BY id)
      SELECT id, CAST(n_messages AS BIGINT) AS n_messages, roles, transcript FROM agg WHERE n_messages >= {fixed.MIN_TURNS}"""


def security_sql(langs=SECURITY_QUERY_LANGS) -> str:
    inlist = ", ".join(lit(x.lower()) for x in langs)
    return f"""
      SELECT id, {lit(fixed.SECURITY_INSTRUCTION)} AS instruction,
             {lit(fixed.VULNERABILITY_HEADING)} || v || {lit(fixed.CODE_TO_AUDIT_HEADING)}
               || rj || {lit(fixed.CODE_CLOSE)} AS input,
             {lit(fixed.SECURITY_ANALYSIS_HEADING)} || v || {lit(fixed.SECURE_IMPLEMENTATION_HEADING)}
               || ch || {lit(fixed.CODE_CLOSE)} AS output
      FROM (SELECT doc_id AS id, {cl('source')} AS v, {cl(first_line('text'))} AS q, {cl('text')} AS ch,
                   {cl('reverse(text)')} AS rj
            FROM documents WHERE lower({cl('lang')}) IN ({inlist}))
      WHERE q <> '' AND ch <> '' AND rj <> ''"""


def optimization_sql(groups=OPT_QUERY_GROUPS) -> str:
    conds = " AND ".join(any_of("lower(coalesce(first_text, ''))", g) for g in groups)
    return f"""
      WITH t AS ({renamed_turns_sql()}),
      c AS (SELECT conv_id AS id, count(*) AS n, min(turn) AS t0, arg_min(text, turn) AS first_text
            FROM t GROUP BY conv_id),
      k AS (SELECT * FROM c WHERE n >= {fixed.MIN_TURNS} AND {conds}),
      parts AS (SELECT t.conv_id AS id, count(*) AS n_parts,
                       string_agg({cl('t.text')}, {NL} || {NL} ORDER BY t.turn) AS output
                FROM t JOIN k ON t.conv_id = k.id
                WHERE t.turn > k.t0 AND t.role = 'assistant' GROUP BY t.conv_id)
      SELECT k.id, {lit(fixed.OPTIMIZATION_INSTRUCTION)} AS instruction, {cl('k.first_text')} AS input, parts.output
      FROM k JOIN parts ON k.id = parts.id"""


def function_code_sql() -> str:
    q = ("CASE WHEN doc_id % 3 = 0 THEN 'r\"\"\"' WHEN doc_id % 3 = 1 THEN " + lit("'''") + " ELSE '\"\"\"' END")
    lead = f"CASE WHEN doc_id % 4 = 1 THEN {NL} || '    x = \"\"\"' || lang || '\"\"\"' ELSE '' END"
    return (
        f"'def f_' || CAST(doc_id AS VARCHAR) || '():' || {lead} || {NL} || '    ' || {q} || text "
        f"|| right({q}, 3) || {NL} || '    return ' || CAST(n_chars AS VARCHAR) || {NL}"
    )


def strip_docstring_sql(src: str) -> str:
    """(id, stripped) for a relation ``src`` with (id, code), line-wise."""
    return f"""
      l AS (SELECT id, line, pos, regexp_replace(trim(line, {WS}), '^[rRuUbB]+', '') AS chk
            FROM {src}, unnest(string_split(code, {NL})) WITH ORDINALITY AS u(line, pos)),
      op AS (SELECT id, min(pos) AS o FROM l
             WHERE starts_with(chk, '\"\"\"') OR starts_with(chk, {lit("'''")}) GROUP BY id),
      oq AS (SELECT op.id, op.o, substr(l.chk, 1, 3) AS q, contains(substr(l.chk, 4), substr(l.chk, 1, 3)) AS same
             FROM op JOIN l ON l.id = op.id AND l.pos = op.o),
      cl AS (SELECT oq.id, min(l.pos) AS c FROM oq JOIN l ON l.id = oq.id AND l.pos > oq.o AND contains(l.line, oq.q)
             GROUP BY oq.id),
      rng AS (SELECT oq.id, oq.o, CASE WHEN oq.same THEN oq.o WHEN cl.c IS NOT NULL THEN cl.c ELSE 9223372036854775807 END AS e
              FROM oq LEFT JOIN cl ON oq.id = cl.id),
      stripped AS (SELECT l.id, coalesce(string_agg(l.line, {NL} ORDER BY l.pos)
                                         FILTER (WHERE rng.o IS NULL OR l.pos < rng.o OR l.pos > rng.e), '') AS stripped
                   FROM l LEFT JOIN rng ON l.id = rng.id GROUP BY l.id)"""


def docstring_strip_sql() -> str:
    return f"""
      WITH f AS (SELECT doc_id AS id, {function_code_sql()} AS code FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL),
      {strip_docstring_sql('f')}
      SELECT id, stripped FROM stripped"""


def docs_sql() -> str:
    return f"""
      WITH f AS (SELECT doc_id AS id, {cl(function_code_sql())} AS code, {cl(first_line('text'))} AS docstring
                 FROM documents),
      k AS (SELECT * FROM f WHERE code <> '' AND docstring <> '' AND length(docstring) >= {fixed.MIN_OUTPUT_CHARS}
                               AND length(code) <= {fixed.MAX_CODE_CHARS}),
      {strip_docstring_sql('k')}
      SELECT k.id, {lit(fixed.DOCS_INSTRUCTION)} AS instruction, '```python' || {NL} || s.stripped || {NL} || '```' AS input,
             k.docstring AS output
      FROM k JOIN stripped s ON k.id = s.id"""


def ranked_records_sql(records: str, key: str = "id") -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order_hash(key)}, {key}) AS rank FROM ({records})"


def shuffle_rank_sql() -> str:
    return f"SELECT id, CAST(rank AS BIGINT) AS rank FROM ({ranked_records_sql(code_writer_sql())})"


def grouped_docs_sql() -> str:
    return f"""
      SELECT nullif(lang, 'fr') AS g, doc_id, CAST(least(strlen(coalesce(text, '')), {PACK_LEN}) AS BIGINT) AS len,
             row_number() OVER (PARTITION BY nullif(lang, 'fr') ORDER BY {order_hash('doc_id')}, doc_id) AS rank
      FROM documents"""


def rank_by_group_sql() -> str:
    return f"SELECT g, doc_id, CAST(rank AS BIGINT) AS rank FROM ({grouped_docs_sql()})"


def pack_by_group_sql() -> str:
    L = PACK_LEN
    return f"""
      WITH RECURSIVE r AS ({grouped_docs_sql()}),
      w AS (
        SELECT g, rank, doc_id, len, CAST(0 AS BIGINT) AS start, CAST(0 AS BIGINT) AS sep FROM r WHERE rank = 1
        UNION ALL
        SELECT r.g, r.rank, r.doc_id, r.len,
               CAST(w.start + w.len + CASE WHEN (w.start + w.len) % {L} <> 0 THEN 1 ELSE 0 END AS BIGINT),
               CAST(CASE WHEN (w.start + w.len) % {L} <> 0 THEN 1 ELSE 0 END AS BIGINT)
        FROM w JOIN r ON r.g IS NOT DISTINCT FROM w.g AND r.rank = w.rank + 1)
      SELECT g, doc_id, start AS pack_start, sep AS pack_sep, len AS length FROM w"""


def sample_n_sql(n: int = SAMPLE_N) -> str:
    return f"""
      SELECT id, CAST(rank AS BIGINT) AS rank, instruction, input, output
      FROM ({ranked_records_sql(code_writer_sql())}) WHERE rank <= {n}"""


def split_sql(fraction: float = fixed.EVAL_FRACTION) -> str:
    return f"""
      SELECT id, CASE WHEN rank <= ceil({fraction!r} * n) THEN 'eval' ELSE 'train' END AS split
      FROM (SELECT id, row_number() OVER (ORDER BY {order_hash('id')}, id) AS rank, count(*) OVER () AS n
            FROM ({code_writer_sql()}))"""


def split_stats_sql() -> str:
    return f"SELECT split, CAST(count(*) AS BIGINT) AS n FROM ({split_sql()}) GROUP BY split"


# ---------------------------------------------------------------------------
# Rendering, recipes, all roles, stats, sinks
# ---------------------------------------------------------------------------


def render_instruction_sql(i: str = "instruction", inp: str = "input", o: str = "output") -> str:
    h1, h2, h3 = fixed.INSTRUCTION_HEADINGS
    return f"{lit(h1)} || {i} || {lit(h2)} || {inp} || {lit(h3)} || {o}"


def instruction_roles_sql() -> dict[str, str]:
    return {
        "code_writer": code_writer_sql(),
        "test_generator": test_capped_sql(),
        "security_auditor": security_sql(),
        "performance_optimizer": optimization_sql(),
        "docs_generator": docs_sql(),
    }


def recipes_sql() -> str:
    rows = ", ".join(
        f"({lit(r)}, {lit(f)}, CAST({m} AS BIGINT), {str(p).lower()})" for r, f, m, p in fixed.RECIPES
    )
    return f"SELECT * FROM (VALUES {rows}) AS t(role, format, max_seq_length, packing)"


def all_roles_sql() -> str:
    """(role, id, text) of every role, rendered by its recipe format."""
    parts = [
        f"SELECT {lit(role)} AS role, id, {render_instruction_sql()} AS text FROM ({sql})"
        for role, sql in instruction_roles_sql().items()
    ]
    parts.append(f"SELECT 'static_reviewer' AS role, id, transcript AS text FROM ({review_sql()})")
    return " UNION ALL ".join(parts)


def instruction_text_sql() -> str:
    return f"SELECT id, {render_instruction_sql()} AS text FROM ({code_writer_sql()})"


def chat_text_sql() -> str:
    return f"SELECT id, transcript AS text FROM ({review_sql()})"


def custom_roles_sql() -> str:
    return f"""
      SELECT 'brief' AS role, id, false AS packing, text FROM ({instruction_text_sql()})
      UNION ALL SELECT 'audit' AS role, id, true AS packing, text FROM ({chat_text_sql()})"""


def recipe_join_sql() -> str:
    return f"""
      SELECT a.role, a.id, r.format, r.max_seq_length, r.packing
      FROM ({all_roles_sql()}) a JOIN ({recipes_sql()}) r ON a.role = r.role"""


def dataset_stats_sql() -> str:
    inst = " UNION ALL ".join(
        f"SELECT {lit(role)} AS role, to_json(struct_pack(instruction := instruction, input := input, output := output)) AS line FROM ({sql})"
        for role, sql in instruction_roles_sql().items()
    )
    return f"""
      WITH lines AS ({inst}
        UNION ALL
        SELECT 'static_reviewer' AS role, to_json(struct_pack(messages := messages)) AS line FROM (
          SELECT id, list(struct_pack(role := role, content := content) ORDER BY turn) AS messages
          FROM (SELECT conv_id AS id, turn, {norm_role('role')} AS role, {cl('text')} AS content
                FROM ({renamed_turns_sql()}))
          WHERE content <> '' AND id IN (SELECT id FROM ({review_sql()}))
          GROUP BY id))
      SELECT role, CAST(count(*) AS BIGINT) AS records, CAST(sum(octet_length(encode(CAST(line AS VARCHAR))) + 1) AS BIGINT) AS bytes,
             CAST(count(DISTINCT role) AS BIGINT) AS datasets
      FROM lines GROUP BY ROLLUP (role)"""


def jsonl_roundtrip_sql() -> str:
    return f"SELECT instruction, input, output FROM ({code_writer_sql()})"


# ---------------------------------------------------------------------------
# Validation
# ---------------------------------------------------------------------------


def event_lines_sql() -> str:
    return """
      SELECT 'events.jsonl' AS file, event_id + 1 AS line,
             CASE WHEN event_type = 'error' THEN substr(props, 1, length(props) - 1)
                  WHEN event_type = 'signup' AND value < 10 THEN replace(props, '"', '''')
                  WHEN event_type = 'view' AND value > 30 THEN '[' || props || ']'
                  WHEN event_type = 'click' AND value < 5 THEN replace(props, '"k"', '"j"')
                  WHEN event_type = 'purchase' AND value < 2 THEN '   '
                  ELSE props END AS value
      FROM events"""


def checked_lines_sql(lines: str | None = None) -> str:
    v = f"trim(value, {WS})"
    return f"""
      SELECT file, line, value, CASE WHEN NOT json_valid({v}) THEN 'invalid_json'
                              WHEN json_type({v}) <> 'OBJECT' THEN 'not_object'
                              WHEN NOT list_contains(json_keys({v}), 'k') THEN 'missing_fields'
                              ELSE 'ok' END AS issue
      FROM ({lines or event_lines_sql()}) WHERE {cl('value')} <> ''"""


def validation_report_sql() -> str:
    return f"SELECT file, CAST(line AS BIGINT) AS line, issue FROM ({checked_lines_sql()}) WHERE issue <> 'ok'"


def validation_counts_sql() -> str:
    return f"SELECT file, CAST(count_if(issue = 'ok') AS BIGINT) AS records FROM ({checked_lines_sql()}) GROUP BY file"


def event_files_sql() -> str:
    """The event lines as files; ``file`` is the number of the file."""
    n = EVENT_FILE_LINES
    return f"""
      SELECT (line - 1) // {n} AS file, (line - 1) % {n} + 1 AS line,
             CASE WHEN (line - 1) // {n} % 5 = 3 THEN ' ' ELSE value END AS value
      FROM ({event_lines_sql()})"""


def file_report_sql() -> str:
    checked = checked_lines_sql(event_files_sql())
    return f"""
      SELECT file AS part, CAST(line AS BIGINT) AS line, issue,
             CASE issue WHEN 'missing_fields' THEN 'missing ["k"]' WHEN 'not_object' THEN 'list' END AS detail
      FROM ({checked}) WHERE issue <> 'ok'
      UNION ALL SELECT -1, NULL, 'empty', 'file has no bytes'
      UNION ALL SELECT DISTINCT file, NULL::BIGINT, 'sha256', NULL FROM ({event_files_sql()}) WHERE file % 4 = 1
      UNION ALL SELECT file, NULL, 'no_records', 'file has no valid record'
        FROM (SELECT e.file, count_if(coalesce(c.issue = 'ok', false)) AS n FROM (SELECT DISTINCT file FROM ({event_files_sql()})) e
              LEFT JOIN ({checked}) c ON e.file = c.file GROUP BY e.file) WHERE n = 0"""


def validate_files_sql() -> str:
    return f"SELECT CAST(part AS BIGINT) AS part, line, issue, detail FROM ({file_report_sql()})"


def validate_first_sql() -> str:
    rank = "CASE issue WHEN 'empty' THEN 1 WHEN 'sha256' THEN 2 WHEN 'no_records' THEN 4 ELSE 3 END"
    return f"""
      SELECT CAST(part AS BIGINT) AS part, line, issue
      FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY {rank}, line) AS k FROM ({file_report_sql()}))
      WHERE k = 1"""


def file_counts_sql() -> str:
    return f"""
      SELECT CAST(e.file AS BIGINT) AS part, CAST(count_if(coalesce(c.issue = 'ok', false)) AS BIGINT) AS records
      FROM (SELECT DISTINCT file FROM ({event_files_sql()})) e
      LEFT JOIN ({checked_lines_sql(event_files_sql())}) c ON e.file = c.file GROUP BY e.file"""


def write_status_sql() -> str:
    return f"""
      SELECT role, CAST(count(*) AS BIGINT) AS records, NULL::VARCHAR AS error FROM ({all_roles_sql()}) GROUP BY role"""


def prepare_eval_file_sql() -> str:
    return f"""
      SELECT part, CAST(len(ids) AS BIGINT) AS n_tokens, md5(array_to_string(ids, ',')) AS ids_md5
      FROM (SELECT CASE role WHEN 'code_writer' THEN 'train' ELSE 'eval' END AS part, {byte_ids_sql('text', PACK_LEN)} AS ids
            FROM ({all_roles_sql()}) WHERE role IN ('code_writer', 'docs_generator'))"""


def prepare_from_jsonl_sql() -> str:
    ids_md5 = "md5(array_to_string(ids, ','))"
    return f"""
      WITH RECURSIVE recs AS (
        SELECT role, 'role=' || role || '/chunk=' || (id // {ROLE_FILE_IDS}) AS file, text,
               row_number() OVER (PARTITION BY role, id // {ROLE_FILE_IDS} ORDER BY id) AS line
        FROM ({all_roles_sql()})),
      ranked AS (
        SELECT *, count(*) OVER (PARTITION BY role) AS n,
               row_number() OVER (PARTITION BY role ORDER BY {order_hash("file || ':' || line")}, file, line) AS rk
        FROM recs),
      sides AS (
        SELECT k.role, file || ':' || line AS item, rk, max_seq_length AS L, packing,
               CASE WHEN rk <= ceil({fixed.EVAL_FRACTION!r} * n) THEN 'eval' ELSE 'train' END AS part,
               {byte_ids_sql('text', 'max_seq_length')} AS ids
        FROM ranked k JOIN ({recipes_sql()}) c ON k.role = c.role),
      s AS (
        SELECT role, L, ids, len(ids) AS len, row_number() OVER (PARTITION BY role ORDER BY rk) AS r
        FROM sides WHERE part = 'train' AND packing),
      p(role, r, pos, start, sep) AS (
        SELECT DISTINCT role, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT FROM s
        UNION ALL
        SELECT s.role, s.r, p.pos + CASE WHEN p.pos % s.L <> 0 THEN 1 ELSE 0 END + s.len,
               p.pos + CASE WHEN p.pos % s.L <> 0 THEN 1 ELSE 0 END,
               CASE WHEN p.pos % s.L <> 0 THEN 1 ELSE 0 END
        FROM p JOIN s ON s.role = p.role AND s.r = p.r + 1),
      placed AS (SELECT s.role, s.L, s.ids, s.len, p.start, p.sep FROM s JOIN p ON s.role = p.role AND s.r = p.r),
      toks AS (
        SELECT role, L, start - 1 AS pos, 0 AS tok FROM placed WHERE sep = 1
        UNION ALL
        SELECT role, L, start + k - 1 AS pos, t AS tok FROM placed, unnest(ids) WITH ORDINALITY AS u(t, k)),
      fin AS (SELECT role, max(start + len) // any_value(L) AS full_blocks FROM placed GROUP BY role)
      SELECT t.role, 'train' AS part, CAST(pos // L AS VARCHAR) AS item, CAST(count(*) AS BIGINT) AS n_tokens,
             md5(string_agg(CAST(tok AS VARCHAR), ',' ORDER BY pos)) AS ids_md5
      FROM toks t JOIN fin ON t.role = fin.role WHERE pos // L < full_blocks GROUP BY t.role, pos // L
      UNION ALL
      SELECT role, part, item, CAST(len(ids) AS BIGINT) AS n_tokens, {ids_md5} AS ids_md5
      FROM sides WHERE part = 'eval' OR NOT packing"""


# ---------------------------------------------------------------------------
# Encoding, packing, collation
# ---------------------------------------------------------------------------

PACK_LEN = 4096
BATCH = 8


def byte_ids_sql(text: str, max_len: int) -> str:
    h = f"hex(encode(coalesce({text}, '')))"
    return (
        f"list_transform(range(0, least(strlen({h}) // 2, {max_len})), "
        f"lambda i: ('0x' || substr({h}, 2 * i + 1, 2))::INTEGER)"
    )


def rendered_sql() -> str:
    return f"SELECT id, {render_instruction_sql()} AS text FROM ({code_writer_sql()})"


def split_text_sql() -> str:
    return f"""
      SELECT id, text, CASE WHEN rk <= ceil({fixed.EVAL_FRACTION!r} * n) THEN 'eval' ELSE 'train' END AS split
      FROM (SELECT id, text, row_number() OVER (ORDER BY {order_hash('id')}, id) AS rk, count(*) OVER () AS n
            FROM ({rendered_sql()}))"""


def byte_tokens_sql() -> str:
    return f"""
      SELECT id, CAST(len(ids) AS BIGINT) AS n_tokens, md5(array_to_string(ids, ',')) AS ids_md5,
             md5(array_to_string(ids, ',')) AS labels_md5, CAST(len(ids) AS BIGINT) AS mask_sum
      FROM (SELECT id, {byte_ids_sql('text', PACK_LEN)} AS ids FROM ({rendered_sql()}))"""


def pack_walk_sql() -> str:
    """Samples of the train split in order, and the sequential walk over them."""
    L = PACK_LEN
    return f"""
      s AS (SELECT id, ids, len(ids) AS len, row_number() OVER (ORDER BY {order_hash('id')}, id) AS r
            FROM (SELECT id, {byte_ids_sql('text', L)} AS ids FROM ({split_text_sql()}) WHERE split = 'train')),
      p(r, pos, start, sep) AS (
        SELECT 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT
        UNION ALL
        SELECT s.r, p.pos + CASE WHEN p.pos % {L} <> 0 THEN 1 ELSE 0 END + s.len,
               p.pos + CASE WHEN p.pos % {L} <> 0 THEN 1 ELSE 0 END,
               CASE WHEN p.pos % {L} <> 0 THEN 1 ELSE 0 END
        FROM p JOIN s ON s.r = p.r + 1),
      placed AS (SELECT s.id, s.ids, s.len, p.start, p.sep FROM s JOIN p ON s.r = p.r)"""


def pack_positions_sql() -> str:
    return f"""
      WITH RECURSIVE {pack_walk_sql()}
      SELECT id, CAST(start AS BIGINT) AS pack_start, CAST(sep AS BIGINT) AS pack_sep,
             CAST(len AS BIGINT) AS length FROM placed"""


def pack_stats_sql() -> str:
    L = PACK_LEN
    return f"""
      WITH RECURSIVE {pack_walk_sql()}
      SELECT CAST(count(*) AS BIGINT) AS samples, CAST(coalesce(max(start + len), 0) // {L} AS BIGINT) AS blocks,
             CAST(coalesce(max(start + len), 0) % {L} AS BIGINT) AS dropped_tokens FROM placed"""


def pack_blocks_sql() -> str:
    L = PACK_LEN
    return f"""
      WITH RECURSIVE {pack_walk_sql()},
      toks AS (
        SELECT start - 1 AS pos, 0 AS tok, -100 AS lab FROM placed WHERE sep = 1
        UNION ALL
        SELECT start + k - 1 AS pos, t AS tok, t AS lab
        FROM placed, unnest(ids) WITH ORDINALITY AS u(t, k)),
      fin AS (SELECT coalesce(max(start + len), 0) // {L} AS full_blocks FROM placed)
      SELECT CAST(pos // {L} AS BIGINT) AS block_id,
             md5(string_agg(CAST(tok AS VARCHAR), ',' ORDER BY pos)) AS ids_md5,
             md5(string_agg(CAST(lab AS VARCHAR), ',' ORDER BY pos)) AS labels_md5,
             CAST(count_if(lab = -100) AS BIGINT) AS separators, CAST({L} AS BIGINT) AS mask_len
      FROM toks WHERE pos // {L} < (SELECT full_blocks FROM fin)
      GROUP BY pos // {L}"""


def collated_sql() -> str:
    return f"""
      WITH e AS (SELECT id, {byte_ids_sql('text', 4096)} AS ids,
                        row_number() OVER (ORDER BY {order_hash('id')}, id) AS r
                 FROM ({split_text_sql()}) WHERE split = 'eval'),
      b AS (SELECT id, ids, (r - 1) // {BATCH} AS batch FROM e),
      m AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) AS blen FROM b)
      SELECT id, CAST(batch AS BIGINT) AS batch, CAST(blen AS BIGINT) AS padded_len,
             md5(array_to_string(list_concat(ids, list_transform(range(blen - len(ids)), lambda i: 0)), ',')) AS ids_md5,
             md5(array_to_string(list_concat(ids, list_transform(range(blen - len(ids)), lambda i: -100)), ',')) AS labels_md5,
             CAST(len(ids) AS BIGINT) AS mask_sum
      FROM m"""


# ---------------------------------------------------------------------------
# Metric monitors and ingest
# ---------------------------------------------------------------------------


def metrics_sql() -> str:
    return """
      SELECT user_id AS run, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step,
             ts, value AS eval_loss FROM events"""


def divergence_sql(threshold: float = fixed.DIVERGENCE_THRESHOLD, patience: int = fixed.DIVERGENCE_PATIENCE) -> str:
    """The sequential rule as a recursive walk per run."""
    ok = "NOT isnan(w.best) AND NOT isnan(m.eval_loss)"
    new_best = f"({ok} AND m.eval_loss < w.best)"
    bad = f"(NOT {new_best} AND {ok} AND m.eval_loss > w.best * {threshold!r})"
    return f"""
      WITH RECURSIVE m AS (
        SELECT run, step, eval_loss, row_number() OVER (PARTITION BY run ORDER BY step) AS k
        FROM ({metrics_sql()}) WHERE eval_loss IS NOT NULL),
      w(run, k, step, eval_loss, best_loss, best, bad, is_bad) AS (
        SELECT run, k, step, eval_loss, NULL::DOUBLE, eval_loss, 0::BIGINT, false FROM m WHERE k = 1
        UNION ALL
        SELECT m.run, m.k, m.step, m.eval_loss, w.best,
               CASE WHEN {new_best} THEN m.eval_loss ELSE w.best END,
               CASE WHEN {bad} THEN w.bad + 1 ELSE 0 END,
               {bad}
        FROM w JOIN m ON m.run = w.run AND m.k = w.k + 1)
      SELECT CAST(run AS BIGINT) AS run, CAST(step AS BIGINT) AS step, eval_loss, best_loss, is_bad,
             CAST(bad AS BIGINT) AS bad_streak, bad >= {patience} AS should_stop
      FROM w"""


def cost_sql(price: float = fixed.GPU_HOUR_PRICE) -> str:
    return f"""
      SELECT CAST(run AS BIGINT) AS run, CAST(step AS BIGINT) AS step, h AS elapsed_hours, h * {price!r} AS cost
      FROM (SELECT run, step, CAST(date_diff('microsecond', min(ts) OVER (PARTITION BY run), ts) AS DOUBLE) / 3.6e9 AS h
            FROM ({metrics_sql()}))"""


def best_checkpoint_sql() -> str:
    return f"""
      SELECT CAST(run AS BIGINT) AS run, CAST(step AS BIGINT) AS best_step, eval_loss AS best_loss
      FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY eval_loss, step) AS rn
            FROM ({metrics_sql()}) WHERE eval_loss IS NOT NULL AND NOT isnan(eval_loss))
      WHERE rn = 1"""


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def vocab_sql(min_count: int = 1) -> str:
    return f"""
      SELECT token, CAST(count(*) AS BIGINT) AS count, CAST(row_number() OVER (ORDER BY count(*) DESC, token) AS BIGINT) AS id
      FROM (SELECT unnest({WORDS}) AS token FROM documents) GROUP BY token HAVING count(*) >= {min_count}"""


def vocab_tokens_sql() -> str:
    return f"""
      WITH vocab AS ({vocab_sql(VOCAB_MIN_COUNT)}),
      held AS (SELECT doc_id, t AS token, k AS pos FROM documents, unnest({WORDS}) WITH ORDINALITY AS u(t, k)),
      ids AS (SELECT doc_id, pos, coalesce(id, 0) AS id FROM held LEFT JOIN vocab USING (token))
      SELECT d.doc_id, CAST(count(i.id) AS BIGINT) AS n_tokens, CAST(count_if(i.id = 0) AS BIGINT) AS n_unknown,
             md5(coalesce(string_agg(CAST(i.id AS VARCHAR), ',' ORDER BY pos), '')) AS ids_md5
      FROM documents d LEFT JOIN ids i ON d.doc_id = i.doc_id GROUP BY d.doc_id"""


def hash_split_sql(fraction: float = fixed.EVAL_FRACTION) -> str:
    part = f"CAST('0x' || substr({order_hash('id')}, 1, 8) AS BIGINT)"
    return f"SELECT id, CASE WHEN {part} / 4294967296.0::DOUBLE < {fraction!r} THEN 'eval' ELSE 'train' END AS split FROM ({code_writer_sql()})"


def jsonl_rejects_sql() -> str:
    lines = f"SELECT (line - 1) // {EVENT_FILE_LINES} AS file, (line - 1) % {EVENT_FILE_LINES} + 1 AS line, value FROM ({event_lines_sql()})"
    return f"""
      SELECT CAST(file AS BIGINT) AS part, CAST(line AS BIGINT) AS line,
             CASE WHEN issue = 'ok' THEN CAST(regexp_extract(value, '"k": *([0-9]+)', 1) AS BIGINT) END AS k,
             nullif(issue, 'ok') AS issue, CASE WHEN issue <> 'ok' THEN value END AS value,
             CAST(count_if(issue = 'ok') OVER () AS BIGINT) AS all_records, CAST(count_if(issue <> 'ok') OVER () AS BIGINT) AS all_rejects
      FROM ({checked_lines_sql(lines)})"""


def write_status_failing_sql() -> str:
    return f"""
      SELECT role, CAST(count(*) AS BIGINT) AS records, false AS failed, CAST(count(*) AS BIGINT) AS lines
      FROM ({all_roles_sql()}) GROUP BY role
      UNION ALL SELECT unnest(['broken_role', 'sourceless_role']), NULL, true, NULL"""


def arrow_encoder_sql() -> str:
    ids = f"list_transform(list_filter(regexp_split_to_array(text, '[{''.join(chr(c) for c in (9, 10, 11, 12, 13, 32))}]+'), lambda w: w <> ''), lambda w: length(w))"
    return f"""
      SELECT id, CAST(len(ids) AS BIGINT) AS n_tokens, md5(array_to_string(ids, ',')) AS ids_md5
      FROM (SELECT doc_id AS id, list_slice(coalesce({ids}, []), 1, 4096) AS ids FROM documents)"""


# ---------------------------------------------------------------------------
# Registry: query name → SQL (names and columns match plans/catalog.py)
# ---------------------------------------------------------------------------


def oracle_sql() -> dict[str, str]:
    return {
        "code_writer_records": code_writer_sql(),
        "test_pairs_capped": test_capped_sql(),
        "test_pairs_json": test_capped_sql(),
        "test_pairs_joined": test_joined_sql(),
        "review_chats": review_sql(),
        "lang_filtered_pairs": security_sql(),
        "optimization_records": optimization_sql(),
        "docstring_strip": docstring_strip_sql(),
        "docs_records": docs_sql(),
        "shuffle_rank": shuffle_rank_sql(),
        "rank_by_group": rank_by_group_sql(),
        "pack_by_group": pack_by_group_sql(),
        "sample_n": sample_n_sql(),
        "train_eval_split": split_sql(),
        "split_stats": split_stats_sql(),
        "instruction_text": instruction_text_sql(),
        "chat_text": chat_text_sql(),
        "recipe_join": recipe_join_sql(),
        "build_all": all_roles_sql(),
        "custom_roles_text": custom_roles_sql(),
        "source_fallback": "SELECT doc_id, CAST(2 AS BIGINT) AS source_index FROM documents WHERE doc_id % 5 <> 0",
        "dataset_stats": dataset_stats_sql(),
        "jsonl_roundtrip": jsonl_roundtrip_sql(),
        "validation_report": validation_report_sql(),
        "validation_counts": validation_counts_sql(),
        "validate_files": validate_files_sql(),
        "validate_files_first": validate_first_sql(),
        "validate_files_counts": file_counts_sql(),
        "split_column": "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split, CAST(2 AS BIGINT) AS source_index FROM documents",
        "fallback_builder": f"SELECT *, CAST(1 AS BIGINT) AS source_index FROM ({test_joined_sql()})",
        "cached_dir": jsonl_roundtrip_sql(),
        "jsonl_rejects": jsonl_rejects_sql(),
        "write_status": write_status_sql(),
        "write_status_failing": write_status_failing_sql(),
        "prepare_from_jsonl": prepare_from_jsonl_sql(),
        "prepare_all_roles": prepare_from_jsonl_sql(),
        "prepare_eval_file": prepare_eval_file_sql(),
        "byte_tokens": byte_tokens_sql(),
        "pack_positions": pack_positions_sql(),
        "pack_stats": pack_stats_sql(),
        "pack_blocks": pack_blocks_sql(),
        "collated_batches": collated_sql(),
        "divergence_batch": divergence_sql(),
        "divergence_chunks": divergence_sql(),
        "divergence_stream": divergence_sql(),
        "divergence_resumed": divergence_sql(),
        "divergence_keyed": divergence_sql(),
        "cost_meter_batch": cost_sql(),
        "cost_meter_stream": cost_sql(),
        "cost_meter_resumed": cost_sql(),
        "best_checkpoint": best_checkpoint_sql(),
        "ingest_new_files": "SELECT doc_id, lang FROM documents WHERE lang IS DISTINCT FROM 'en'",
        "ingest_stream": "SELECT doc_id, lang FROM documents",
        "stream_records": code_writer_sql(),
        "stream_chats": review_sql(),
        "stream_optimizations": optimization_sql(),
        "prepare_blocks": pack_blocks_sql(),
        "arrow_encoder_tokens": arrow_encoder_sql(),
        "hash_split": hash_split_sql(),
        "chat_template_text": chat_text_sql(),
        "vocab_build": vocab_sql(),
        "vocab_tokens": vocab_tokens_sql(),
        "vocab_tokens_joined": vocab_tokens_sql(),
        "stop_steps": f"SELECT run, min(step) AS stop_step FROM ({divergence_sql()}) WHERE should_stop GROUP BY run",
        "ingest_alternating": "SELECT doc_id, lang, CAST(doc_id % 3 + 1 AS BIGINT) AS commit FROM documents",
    }
