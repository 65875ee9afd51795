"""DuckDB oracles for the registered queries (same column names and types).

Written independently of the Spark code, straight from the semantics: the
log fixture uses a plain ``row_number`` window, the Java split uses DuckDB's
regex split plus an explicit ``rtrim``.  DuckDB's ``\\s`` lacks the vertical
tab, so the whitespace class is spelt out.
"""

from __future__ import annotations

from streamledger.plans.queries import (
    ASSIGNED, CAP, CURRENT_TOPICS, GROUP_A, GROUP_B, GROUP_B_LAST_BATCH,
    GROUP_B_PARTITIONS, PARTITIONS, PARTS, PATTERN, SPLIT, SUBSCRIBED)

WS_CHARS = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
WS_RX = r"[ \t\n\x0B\f\r]+"


def java_split(expr: str, chars_sql: str, splitter: str) -> str:
    """Java ``split`` in DuckDB: strip trailing separators, empty list when
    only separators remain of a non-empty string."""
    stripped = f"rtrim({expr}, {chars_sql})"
    return (f"(CASE WHEN {expr} <> '' AND {stripped} = '' THEN []::VARCHAR[] "
            f"ELSE {splitter.format(stripped)} END)")


def ws_split(expr: str) -> str:
    return java_split(expr, WS_CHARS, "string_split_regex({}, '" + WS_RX + "')")


def lit_split(expr: str, sep: str) -> str:
    return java_split(expr, f"'{sep}'", "string_split({}, '" + sep + "')")


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


L = f"""L AS (
  SELECT event_type AS topic,
         CAST(user_id % {PARTITIONS} AS INTEGER) AS "partition",
         CAST(row_number() OVER (PARTITION BY event_type, user_id % {PARTITIONS}
                                 ORDER BY event_id) - 1 AS BIGINT) AS "offset",
         CAST(user_id AS VARCHAR) AS key,
         event_type || ',' || CAST(user_id AS VARCHAR) AS value,
         ts AS "timestamp"
  FROM events)"""

LB = f"""LB AS (SELECT *, CAST("offset" // {CAP} AS BIGINT) AS batch_id FROM L)"""

RANGES = """R AS (
  SELECT batch_id, topic, "partition", min("offset") AS from_offset,
         max("offset") + 1 AS until_offset
  FROM LB GROUP BY batch_id, topic, "partition")"""

OL = f"""OL AS (
  SELECT '{GROUP_A}' AS group_id, topic, "partition", until_offset AS "offset", batch_id
  FROM R
  UNION ALL
  SELECT '{GROUP_B}', topic, "partition", until_offset, batch_id
  FROM R WHERE "partition" IN ({", ".join(map(str, GROUP_B_PARTITIONS))})
           AND batch_id <= {GROUP_B_LAST_BATCH})"""

BASE = f"WITH {L},\n{LB},\n{RANGES},\n{OL}"


def current(group: str, topics: str | None = None) -> str:
    where = f"group_id = '{group}'"
    if topics:
        where += f" AND topic IN ({_in(sorted(set(topics.split(','))))})"
    return (f"SELECT group_id, topic, \"partition\", arg_max(\"offset\", batch_id) AS \"offset\" "
            f"FROM OL WHERE {where} GROUP BY group_id, topic, \"partition\"")


EXTENTS = """SELECT topic, "partition", min("offset") AS earliest, max("offset") + 1 AS latest
  FROM L GROUP BY topic, "partition\""""


def starts(policy: str) -> str:
    return (f"SELECT e.topic, e.\"partition\", coalesce(c.\"offset\", e.{policy}) AS \"offset\" "
            f"FROM ({EXTENTS}) e LEFT JOIN ({current(GROUP_B)}) c "
            f"ON e.topic = c.topic AND e.\"partition\" = c.\"partition\"")


BATCH_COUNTS = f"""BC AS (
  SELECT batch_id, word, count(*) AS n
  FROM (SELECT batch_id, unnest({ws_split('value')}) AS word FROM LB)
  GROUP BY batch_id, word)"""

_assigned_rows = ", ".join(
    f"('{t}', {p}, {a}, {'NULL' if b is None else b})" for (t, p), (a, b) in sorted(ASSIGNED.items(), key=lambda x: x[0]))

UTF16_LEN = "(length({0}) + len(regexp_extract_all({0}, '[\\x{{10000}}-\\x{{10FFFF}}]')))"

PAIRS = f"""WITH F AS (SELECT conv_id, turn, {lit_split('text', ',')} AS fs FROM conversations)"""

ORACLES: dict[str, str] = {
    "word_count": f"""
SELECT word, count(*) AS n
FROM (SELECT unnest({ws_split('text')}) AS word FROM documents)
GROUP BY word""",

    "space_tokens": f"""
WITH lines AS (SELECT unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS line FROM documents),
toks AS (SELECT unnest({lit_split('line', ' ')}) AS token FROM lines)
SELECT count(*) AS num,
       CAST(coalesce(sum({UTF16_LEN.format('token')}), 0) AS BIGINT) AS total,
       sum({UTF16_LEN.format('token')}) / count(*) AS avg_len
FROM toks""",

    "text_lines": """
SELECT doc_id, CAST(unnest(range(len(arr))) AS INTEGER) AS line_no, unnest(arr) AS line
FROM (SELECT doc_id, string_split_regex(text, '\\r\\n|\\r|\\n') AS arr FROM documents)""",

    "text_file_lines": """
SELECT line, count(*) AS n
FROM (SELECT unnest(string_split_regex(text || chr(10), '\\r\\n|\\r|\\n')[:-2]) AS line
      FROM documents WHERE text IS NOT NULL)
GROUP BY line""",

    "batch_word_count": f"""{BASE},\n{BATCH_COUNTS}
SELECT batch_id, word, n FROM BC""",

    "running_word_count": f"""{BASE},\n{BATCH_COUNTS}
SELECT word, CAST(sum(n) AS BIGINT) AS n FROM BC GROUP BY word""",

    "running_word_count_update": f"""{BASE},\n{BATCH_COUNTS}
SELECT batch_id, word,
       CAST(sum(n) OVER (PARTITION BY word ORDER BY batch_id) AS BIGINT) AS n
FROM BC""",

    "batch_record_count": f"""{BASE}
SELECT batch_id, count(*) AS n FROM LB GROUP BY batch_id""",

    "topic_subscribe": f"""{BASE}
SELECT * FROM L WHERE topic IN ({_in(sorted(SUBSCRIBED.split(',')))})""",

    "topic_pattern": f"""{BASE}
SELECT * FROM L WHERE regexp_full_match(topic, '{PATTERN}')""",

    "message_kv": f"""{BASE}
SELECT key, value FROM L""",

    "message_tv": f"""{BASE}
SELECT topic, value FROM L""",

    "assigned_ranges": f"""{BASE}
SELECT L.* FROM L
JOIN (VALUES {_assigned_rows}) AS A(t, p, from_offset, until_offset)
  ON L.topic = A.t AND L."partition" = A.p
WHERE L."offset" >= A.from_offset AND (A.until_offset IS NULL OR L."offset" < A.until_offset)""",

    "start_earliest": f"""{BASE}
{starts('earliest')}""",

    "start_latest": f"""{BASE}
{starts('latest')}""",

    "rate_limited_ranges": f"""{BASE},
S AS ({starts('earliest')}),
E AS ({EXTENTS})
SELECT S.topic, S."partition", S."offset" AS from_offset,
       greatest(S."offset", least(E.latest, S."offset" + {CAP})) AS until_offset
FROM S JOIN E ON S.topic = E.topic AND S."partition" = E."partition\"""",

    "next_batch": f"""{BASE},
S AS ({starts('earliest')}),
E AS ({EXTENTS})
SELECT L.* FROM L
JOIN S ON L.topic = S.topic AND L."partition" = S."partition"
JOIN E ON L.topic = E.topic AND L."partition" = E."partition"
WHERE L."offset" >= S."offset" AND L."offset" < least(E.latest, S."offset" + {CAP})""",

    "batch_ranges": f"""{BASE}
SELECT * FROM R""",

    "offsets_current": f"""{BASE}
{current(GROUP_A, CURRENT_TOPICS)}""",

    "offsets_guard": f"""{BASE},
C AS ({current(GROUP_B)})
SELECT R.batch_id, R.topic, R."partition", R.from_offset, R.until_offset,
       C."offset" AS stored,
       CASE WHEN coalesce(C."offset", R.from_offset) = R.from_offset THEN 'commit'
            WHEN C."offset" = R.until_offset THEN 'skip'
            ELSE 'raise' END AS verdict
FROM R LEFT JOIN C ON R.topic = C.topic AND R."partition" = C."partition\"""",

    "offsets_seed": f"""{BASE},
C AS ({current(GROUP_B)}),
P AS (SELECT DISTINCT topic, "partition" FROM L)
SELECT '{GROUP_B}' AS group_id, P.topic, P."partition", CAST(0 AS BIGINT) AS "offset"
FROM P WHERE NOT EXISTS (
  SELECT 1 FROM C WHERE C.topic = P.topic AND C."partition" = P."partition")""",

    "offsets_tall": f"""{BASE},
C AS ({current(GROUP_A)})
SELECT topic || '_' || CAST("partition" AS VARCHAR) AS rowkey, "offset", topic, "partition"
FROM C""",

    "offsets_path": f"""{BASE},
C AS ({current(GROUP_A)})
SELECT topic || '/' || group_id || '/' || CAST("partition" AS VARCHAR) AS path,
       CAST("offset" AS VARCHAR) AS data
FROM C""",

    "offsets_wide": f"""{BASE},
C AS ({current(GROUP_A)})
SELECT topic || '-' || group_id AS rowkey,
{",".join(f'''       max(CASE WHEN "partition" = {p} THEN "offset" END) AS "{p}"''' for p in range(PARTITIONS))}
FROM C GROUP BY topic || '-' || group_id""",

    "offsets_unpivot": f"""{BASE}
{current(GROUP_A)}""",

    "offsets_path_parse": f"""{BASE}
{current(GROUP_A)}""",

    "offsets_path_files": f"""{BASE}
{current(GROUP_A)}""",

    "parse_pairs_strict": f"""{PAIRS}
SELECT conv_id, turn, coalesce(len(fs) = 2, false) AS ok,
       CASE WHEN len(fs) = 2 THEN fs[1] END AS name,
       CASE WHEN len(fs) = 2 THEN fs[2] END AS id
FROM F""",

    "parse_pairs_lenient": f"""{PAIRS}
SELECT conv_id, turn, ok, CASE WHEN ok THEN fs[1] END AS name,
       CASE WHEN ok THEN TRY_CAST(fs[2] AS BIGINT) END AS id
FROM (SELECT *, coalesce(len(fs) >= 2 AND regexp_full_match(fs[2], '[+-]?[0-9]+')
                         AND TRY_CAST(fs[2] AS BIGINT) IS NOT NULL, false) AS ok FROM F)""",

    "upsert_latest": f"""{BASE},
P AS (SELECT batch_id, "offset", topic, "partition", {lit_split('value', ',')} AS fs FROM LB),
V AS (SELECT fs[2] AS order_id, fs[1] AS name,
             row_number() OVER (PARTITION BY fs[2]
                                ORDER BY batch_id DESC, "offset" DESC, topic DESC,
                                         "partition" DESC) AS rn
      FROM P WHERE len(fs) = 2)
SELECT order_id, name FROM V WHERE rn = 1""",

    "append_rows": f"""{BASE},
P AS (SELECT "offset", topic, "partition", {lit_split('value', ',')} AS fs FROM L)
SELECT fs[1] AS name, TRY_CAST(fs[2] AS BIGINT) AS id, topic, "partition", "offset"
FROM P WHERE len(fs) >= 2""",

    "committed_offsets": f"""{BASE},
P AS (SELECT "offset", topic, "partition", {lit_split('value', ',')} AS fs FROM L)
SELECT '{GROUP_A}' AS group_id, topic, "partition", max("offset") + 1 AS "offset"
FROM P WHERE len(fs) >= 2 GROUP BY topic, "partition\"""",
}


def parts_sql(sql: str) -> str:
    """An oracle with the log's two parts for its batches (resumed stream queries)."""
    parts = f'LB AS (SELECT *, CAST(CASE WHEN "offset" < {SPLIT} THEN 0 ELSE 1 END AS BIGINT) AS batch_id FROM L)'
    return sql.replace(LB, parts)


def even_parts_sql(sql: str) -> str:
    """An oracle with even shares of every partition for its batches (stream queries)."""
    size = 'max("offset") OVER (PARTITION BY topic, "partition") + 1'
    return sql.replace(LB, f'LB AS (SELECT *, CAST({PARTS} * "offset" // ({size}) AS BIGINT) AS batch_id FROM L)')
