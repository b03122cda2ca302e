"""DuckDB SQL that computes every query of the catalog a second way.

The SQL shares only the page layouts and the fixed values with the Spark side.  It
unnests matches into rows and uses windows where the library works on arrays.
"""

from __future__ import annotations

from policyscan import fixed
from policyscan.plans import corpus
from policyscan.plans.catalog import CUSTOM_PATTERNS, EARLIER, STAMP

LEVELS = ", ".join(f"'{s}'" for s in fixed.SEVERITIES)
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
INLINE_SPACE = SPACE.replace(r"\t-\r", r"\t\x0b-\r")
STRICT = r"^(CKV_[A-Z0-9]+_[A-Z0-9_]+|(CKV2|CKV3|BC)_[A-Z0-9]+_[0-9]+)$"
ACCEPT = r"^(CKV_[A-Z0-9]+_[A-Z0-9_]+|[A-Z][A-Z0-9]*_[A-Z][A-Z0-9]*_[A-Z0-9_]+)$"
RANK = "CASE {} " + " ".join(f"WHEN '{s}' THEN {r}" for s, r in fixed.SEVERITY_RANK.items()) + " END"
ACCEPTED = f"(length(id) >= 3 AND regexp_matches(id, '{ACCEPT}'))"


def quote(value: str) -> str:
    """SQL string of any text; control characters are spelled with chr()."""
    parts, plain = [], ""
    for char in value:
        if ord(char) < 32 or ord(char) > 126:
            parts += [f"'{plain}'"] if plain else []
            parts.append(f"chr({ord(char)})")
            plain = ""
        else:
            plain += "''" if char == "'" else char
    parts += [f"'{plain}'"] if plain or not parts else []
    return "(" + " || ".join(parts) + ")"


# --- the corpus -----------------------------------------------------------------

FIELDS = f"""
  o_orderkey AS k, o_orderkey // 3 AS g, CAST(o_orderkey % {corpus.VARIANTS} AS INTEGER) AS v,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL' WHEN '2-HIGH' THEN 'HIGH'
    WHEN '3-MEDIUM' THEN 'MEDIUM' WHEN '5-LOW' THEN 'LOW' ELSE 'INFO' END AS sev,
  [{", ".join(f"'{p}'" for p in corpus.PROVIDER_CYCLE)}][CAST((o_orderkey // 3) % {len(corpus.PROVIDER_CYCLE)} AS INTEGER) + 1] AS prov,
  o_orderstatus, o_orderpriority, o_orderdate"""


def _layout(layout: str) -> str:
    names = {
        "id": "id",
        "sev": "sev",
        "other": "CASE WHEN sev = 'LOW' THEN 'HIGH' ELSE 'LOW' END",
        "mixed": "(sev[1] || lower(sev[2:]))",
        "k": "CAST(k AS VARCHAR)",
        "prose": "prose",
        "noise": quote(corpus.NOISE),
    }
    out = []
    for piece in layout.split("{"):
        name, closed, rest = piece.partition("}")
        out += [names[name], quote(rest)] if closed else [quote(piece)]
    return " || ".join(f"({p})" if "CASE" in p else p for p in out)


PATH = """'docs/' || lower(prov) || CASE WHEN k % 2 = 0 THEN '-policies/' ELSE '/' END
  || CASE WHEN k % 25 = 7 THEN 'node_modules/' WHEN k % 25 = 11 THEN '.cache/'
          WHEN k % 10 = 3 THEN 'archive/old/' ELSE '' END
  || CASE WHEN k % 50 = 0 THEN 'index' ELSE 'p' END || k
  || CASE WHEN k % 41 = 0 THEN '.txt' WHEN k % 37 = 0 THEN '.ADOC' ELSE '.adoc' END"""

CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (body, list(needs))


def sql(final: str, *needs: str) -> str:
    """WITH … final, with the CTEs that are needed in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][1]:
            visit(need)
        if name not in order:
            order.append(name)

    for need in needs:
        visit(need)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n][0]})" for n in order)
    return f"WITH {ctes}\n{final}"


cte("keyed", f"SELECT *, 'CKV_' || prov || '_' || g AS id, {PATH} AS path FROM (SELECT {FIELDS} FROM orders)")
cte(
    "pages",
    f"""SELECT k, g, v, sev, prov, id, path, o_orderstatus, o_orderdate AS mtime,
  CASE v {" ".join(f"WHEN {v} THEN {_layout(x)}" for v, x in enumerate(corpus.LAYOUTS))} END AS content
FROM (SELECT keyed.*, d.text AS prose FROM keyed
      JOIN documents d ON d.doc_id = (SELECT min(doc_id) FROM documents) + k % (SELECT count(*) FROM documents))""",
    "keyed",
)


def newlines(expr: str) -> str:
    return rf"regexp_replace({expr}, '\r\n?', chr(10), 'g')"


cte(
    "docs",
    f"SELECT k, path, o_orderstatus, mtime, octet_length(encode(content)) AS file_size, {newlines('content')} AS content FROM pages",
    "pages",
)
NONBLANK = f"regexp_matches(content, '[^{SPACE}]')"
KEYWORD = "(contains(lower(content), 'checkov') OR contains(lower(content), 'severity'))"
VISIBLE = (
    r"(length(regexp_replace(content, '\p{C}', '', 'g'))"
    r" + length(content) - length(regexp_replace(content, '[\t-\r\x1c-\x1f\x{85}]', '', 'g')))"
)
BINARY = f"(length(content) > 0 AND {VISIBLE} / CAST(length(content) AS DOUBLE) < 0.7)"
GATE = f"(length(content) >= 50 AND {KEYWORD} AND {NONBLANK} AND NOT {BINARY})"


def sha16(expr: str) -> str:
    return f"sha256({expr})[1:16]"


# --- matching -------------------------------------------------------------------


def matching_ctes(prefix: str, patterns: list[tuple], source: str = "docs") -> None:
    """CTEs <prefix>_live, _raw, _hits, _sevs, _ids and _docs of one pattern set.

    ``patterns`` are (name, regex, priority, kind) in matching order per kind.
    """
    p = prefix
    cte(f"{p}_live", f"SELECT path, content, {sha16('content')} AS content_hash FROM {source} WHERE {GATE}", source)
    raws, sevs = [], []
    for n, (name, regex, priority, _) in enumerate(x for x in patterns if x[3] == "id"):
        raws.append(
            f"""SELECT path, content, {n} AS pno, '{name}' AS pattern_name, {priority} AS priority,
  unnest(range(1, n + 1)) AS ord, unnest(ms) AS m, unnest(ids) AS id, unnest(gaps[1:n]) AS gap
FROM (SELECT *, len(ms) AS n FROM (SELECT path, content, regexp_extract_all(content, {quote('(?ms)' + regex)}, 0) AS ms,
  regexp_extract_all(content, {quote('(?ms)' + regex)}, 1) AS ids,
  regexp_split_to_array(content, {quote('(?ms)' + regex)}) AS gaps FROM {p}_live)) WHERE n > 0"""
        )
    for n, (_, regex, priority, _) in enumerate(x for x in patterns if x[3] == "severity"):
        sevs.append(
            f"""SELECT path, {n} AS sno, {priority} AS priority, unnest(range(1, len(ls) + 1)) AS ord, upper(unnest(ls)) AS severity
FROM (SELECT path, regexp_extract_all(content, {quote('(?ms)' + regex)}, 1) AS ls FROM {p}_live)"""
        )
    cte(f"{p}_raw", "\nUNION ALL\n".join(raws), f"{p}_live")
    strong = "(least(1.0, priority / CAST(5 AS DOUBLE) * CAST(1.2 AS DOUBLE) * CASE WHEN pattern_name = 'bracketed_id_generic' THEN CAST(0.7 AS DOUBLE) ELSE 1 END) > 0.8)"
    cte(
        f"{p}_hits",
        f"""SELECT path, pno * 1000000 + ord AS seq, pattern_name, id AS checkov_id, start_position, end_position,
  least(CAST(1.0 AS DOUBLE), priority / CAST(5 AS DOUBLE) * CAST(1.2 AS DOUBLE)
    * CASE WHEN contains(around, '|') OR contains(lower(around), 'table') THEN CAST(1.1 AS DOUBLE) ELSE 1 END
    * CASE WHEN pattern_name = 'bracketed_id_generic' THEN CAST(0.7 AS DOUBLE) ELSE 1 END) AS confidence,
  CASE WHEN length(ctx) > 100 THEN ctx[1:100] || '...' ELSE ctx END AS context
FROM (SELECT *, trim(regexp_replace(substr(content, greatest(start_position - 50, 0) + 1, end_position + 50 - greatest(start_position - 50, 0)), '[{SPACE}]+', ' ', 'g')) AS ctx,
    substr(content, greatest(start_position - 100, 0) + 1, end_position + 100 - greatest(start_position - 100, 0)) AS around
  FROM (SELECT *, end_position - length(m) AS start_position,
      row_number() OVER (PARTITION BY path, pno, {ACCEPTED} ORDER BY ord) AS turn
    FROM (SELECT *, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY path, pno ORDER BY ord) AS BIGINT) AS end_position FROM {p}_raw))
  WHERE {ACCEPTED} AND (NOT {strong} OR turn = 1))""",
        f"{p}_raw",
    )
    cte(
        f"{p}_ids",
        f"""SELECT *, row_number() OVER (PARTITION BY path ORDER BY confidence DESC, slot) AS rank,
  row_number() OVER (PARTITION BY path ORDER BY slot) AS place
FROM (SELECT *, min(seq) OVER (PARTITION BY path, checkov_id) AS slot,
    row_number() OVER (PARTITION BY path, checkov_id ORDER BY confidence DESC, seq) AS best FROM {p}_hits) WHERE best = 1""",
        f"{p}_hits",
    )
    cte(
        f"{p}_sevs",
        f"""SELECT path, severity, row_number() OVER (PARTITION BY path ORDER BY first_seen) - 1 AS pos FROM (
  SELECT path, severity, min(sno * 1000000 + ord) AS first_seen FROM (
    SELECT *, row_number() OVER (PARTITION BY path, sno ORDER BY ord) AS turn FROM ({" UNION ALL ".join(sevs)}) WHERE severity IN ({LEVELS}))
  WHERE priority < 4 OR turn = 1 GROUP BY path, severity)""",
        f"{p}_live",
    )
    cte(
        f"{p}_docs",
        f"""SELECT l.path, l.content, l.content_hash, coalesce(n, 0) AS n, coalesce(m, 0) AS m, sevs, ids, top_id, best,
  CASE WHEN n IS NULL OR m IS NULL THEN CAST(0 AS DOUBLE) WHEN n = 1 AND m = 1 THEN least(CAST(1 AS DOUBLE), best * CAST(1.2 AS DOUBLE))
    ELSE greatest(CAST(0 AS DOUBLE), best * ((1 - (n - 1) * CAST(0.1 AS DOUBLE)) * (1 - (m - 1) * CAST(0.1 AS DOUBLE)))) END AS confidence
FROM {p}_live l
LEFT JOIN (SELECT path, count(*) AS n, max(confidence) AS best, list(checkov_id ORDER BY rank) AS ids, arg_min(checkov_id, rank) AS top_id FROM {p}_ids GROUP BY path) i USING (path)
LEFT JOIN (SELECT path, count(*) AS m, list(severity ORDER BY pos) AS sevs FROM {p}_sevs GROUP BY path) s USING (path)""",
        f"{p}_live",
        f"{p}_ids",
        f"{p}_sevs",
    )
    # Distance of the closest occurrence on either side, found without listing them.
    cte(
        f"{p}_near",
        f"""SELECT path, rank, arg_min(severity, distance * 10 + pos) AS severity FROM (
  SELECT i.path, i.rank, s.severity, s.pos, least(
      CASE WHEN l > 0 THEN start_position - (length(pre) - (l - 1) - length(s.severity)) END,
      CASE WHEN r > 0 THEN r END) AS distance
  FROM (SELECT i.*, lower(d.content) AS lc FROM {p}_ids i JOIN {p}_docs d USING (path)) i JOIN {p}_sevs s USING (path),
  LATERAL (SELECT substr(lc, 1, start_position + length(s.severity)) AS pre),
  LATERAL (SELECT instr(reverse(pre), reverse(lower(s.severity))) AS l, instr(substr(lc, start_position + 2), lower(s.severity)) AS r)
) GROUP BY path, rank""",
        f"{p}_docs",
    )
    cte(
        f"{p}_matches",
        f"""SELECT i.path, i.rank, i.checkov_id, i.confidence, i.start_position, i.end_position, i.context, i.pattern_name,
  CASE WHEN d.m = 0 THEN NULL WHEN i.rank <= d.m THEN d.sevs[i.rank] WHEN d.m = 1 THEN d.sevs[1] ELSE nr.severity END AS severity
FROM {p}_ids i JOIN {p}_docs d USING (path) LEFT JOIN {p}_near nr ON nr.path = i.path AND nr.rank = i.rank""",
        f"{p}_near",
    )
    strict_top = f"CASE WHEN regexp_matches(top_id, '{STRICT}') THEN top_id END"
    cte(
        f"{p}_results",
        f"""SELECT d.path, d.file_size, d.mtime, r.path IS NOT NULL AS passed, {strict_top} AS checkov_id, CASE WHEN top_id IS NOT NULL THEN sevs[1] END AS severity,
  top_id AS raw_checkov_id, CASE WHEN top_id IS NOT NULL THEN sevs[1] END AS raw_severity, coalesce(confidence, 0) AS confidence,
  coalesce(content_hash, '') AS content_hash, coalesce(n, 0) AS match_count, split_part({strict_top}, '_', 2) AS provider
FROM {source} d LEFT JOIN {p}_docs r USING (path)""",
        f"{p}_docs",
    )


def _ordered(rows: list[tuple]) -> list[tuple]:
    """(name, regex, priority, kind) by the name rule, highest priority first."""
    out = []
    for name, regex, priority in rows:
        if any(part in name for part in fixed.ID_NAME_PARTS):
            out.append((name, regex, priority, "id"))
        elif "severity" in name:
            out.append((name, regex, priority, "severity"))
    return sorted(out, key=lambda x: -x[2])


matching_ctes("c", _ordered(fixed.CONFIG_PATTERNS))
matching_ctes("b", _ordered(fixed.BUILTIN_PATTERNS))
matching_ctes(
    "u",
    sorted(
        [(p.name, p.pattern, p.priority, p.kind or "severity") for p in CUSTOM_PATTERNS],
        key=lambda x: -x[2],
    ),
)

cte(
    "found",
    "SELECT path, checkov_id, severity FROM c_results WHERE checkov_id IS NOT NULL AND severity IS NOT NULL",
    "c_results",
)
cte(
    "firsts",
    "SELECT *, first_value(severity) OVER (PARTITION BY checkov_id ORDER BY string_split(path, '/')) AS existing FROM found",
    "found",
)
cte("mappings", "SELECT DISTINCT checkov_id, existing AS severity FROM firsts", "firsts")
cte(
    "agreeing",
    "SELECT existing AS severity, count(*) FILTER (severity = existing) AS files, count(DISTINCT checkov_id) AS ids FROM firsts GROUP BY existing",
    "firsts",
)
cte(
    "existing_db",
    "SELECT id AS checkov_id, arg_min(sev, k) AS severity FROM keyed WHERE o_orderstatus = 'F' GROUP BY id",
    "keyed",
)
cte("second_db", "SELECT DISTINCT id AS checkov_id, 'MEDIUM' AS severity FROM keyed WHERE o_orderstatus = 'O'", "keyed")
cte(
    "doubtful",
    """SELECT CASE WHEN k % 400 = 1 THEN 'CKV2_AWS_FOO' || k || 'X' ELSE 'CKV_' || prov || '_' || k END AS checkov_id,
  CASE WHEN k % 500 = 2 THEN 'SEVERE' WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'CRITICAL' ELSE 'INFO' END AS severity FROM keyed""",
    "keyed",
)
cte(
    "noted",
    """SELECT *, list_filter([
    CASE WHEN match_count = 0 THEN 'Checkov ID not found in ' || path END,
    CASE WHEN match_count > 0 AND severity IS NULL THEN 'Severity missing for ' || raw_checkov_id END,
    CASE WHEN match_count > 0 AND checkov_id IS NULL THEN 'Invalid Checkov text ' || raw_checkov_id END,
    CASE WHEN path LIKE '%.txt' THEN 'Invalid severity column' END,
    CASE WHEN path LIKE '%/.cache/%' THEN 'Permission denied' END,
    CASE WHEN path LIKE '%/node\\_modules/%' ESCAPE '\\' THEN 'Unicode error' END,
    CASE WHEN path LIKE '%/archive/%' THEN 'Timeout after 30 s' END,
    CASE WHEN path LIKE '%.ADOC' THEN 'disk full' END], lambda e: e IS NOT NULL) AS errors,
  CASE WHEN path LIKE '%index%' THEN ['looks like an index page'] ELSE [] END AS warnings FROM c_results""",
    "c_results",
)
CATEGORY = """CASE WHEN contains(lower(message), 'checkov id') AND (contains(lower(message), 'not found') OR contains(lower(message), 'missing')) THEN 'missing_checkov_id'
  WHEN contains(lower(message), 'severity') AND (contains(lower(message), 'not found') OR contains(lower(message), 'missing')) THEN 'missing_severity'
  WHEN contains(lower(message), 'invalid') AND contains(lower(message), 'checkov') THEN 'invalid_checkov_id'
  WHEN contains(lower(message), 'invalid') AND contains(lower(message), 'severity') THEN 'invalid_severity'
  WHEN contains(lower(message), 'permission') OR contains(lower(message), 'access') THEN 'permission_error'
  WHEN contains(lower(message), 'encoding') OR contains(lower(message), 'unicode') THEN 'encoding_error'
  WHEN contains(lower(message), 'timeout') THEN 'timeout_error' ELSE 'other_error' END"""
cte("notes", f"SELECT *, {CATEGORY} AS category FROM (SELECT path, unnest(errors) AS message FROM noted)", "noted")

# --- files ------------------------------------------------------------------------

PLAIN = r"regexp_replace(content, '[^\x00-\x7f]+', '', 'g')"
ACCENT = chr(0xE9) + "t" + chr(0xE9)
cte(
    "manifest",
    f"""SELECT k, path, mtime, k % 97 <> 0 AS readable,
  CASE WHEN k % 97 = 0 THEN NULL WHEN k % 29 = 0 THEN {PLAIN} || {quote(ACCENT)} ELSE content END AS content,
  CASE WHEN k % 97 = 0 THEN 0 WHEN k % 29 = 0 THEN octet_length(encode({PLAIN})) + 3 ELSE octet_length(encode(content)) END AS length
FROM pages""",
    "pages",
)
cte(
    "read_files",
    f"SELECT k, path, NULL::VARCHAR AS o_orderstatus, mtime, length AS file_size, {newlines('content')} AS content FROM manifest WHERE readable",
    "manifest",
)
EXTENSION = r"lower(regexp_extract(string_split(path, '/')[-1], '(?s).(\.[^.]+)$', 1))"


def ignored(*regexes: str) -> str:
    return "(len(list_filter(string_split(path, '/'), lambda x: " + " OR ".join(
        f"regexp_full_match(x, '{r}')" for r in regexes
    ) + ")) > 0)"


DEFAULT_IGNORED = ignored(r"\..*", "node_modules", "dist", "build", "target")
DEPTH = "(len(string_split(path, '/')) - 1)"
matching_ctes("f", _ordered(fixed.CONFIG_PATTERNS), "read_files")
PIPELINE_IGNORED = ignored(".*index.*", r".*policies\.adoc")
matching_ctes("pf", _ordered(fixed.CONFIG_PATTERNS), "pipeline_files")
cte(
    "pipeline_files",
    f"SELECT * FROM read_files WHERE NOT {PIPELINE_IGNORED} AND {EXTENSION} = '.adoc' AND file_size <= {10 * 1024 * 1024}",
    "read_files",
)
WIDE = chr(0xFB01) + "ne " + chr(0xFF21) + chr(0xA0) + "\n"
cte(
    "untidy",
    f"""SELECT k, path, CASE k % 5 WHEN 0 THEN {quote("Title  " + chr(9) + chr(10))} || content || {quote(" \n \n\n\t\n\nend  ")}
  WHEN 1 THEN content || {quote(WIDE)} WHEN 2 THEN chr(65279) || content ELSE content END AS content FROM pages""",
    "pages",
)


def stripped(expr: str) -> str:
    return f"regexp_replace({expr}, '[{INLINE_SPACE}]+(\\n|$)', '\\1', 'g')"


def collapsed(expr: str) -> str:
    return f"regexp_replace({expr}, '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g')"


def composed(expr: str) -> str:
    """NFKC of texts whose only compatibility characters are the ones added above."""
    return f"replace(replace(replace({expr}, chr({0xFB01}), 'fi'), chr({0xFF21}), 'A'), chr(160), ' ')"


cte("lined", f"SELECT path, content AS original, {stripped(newlines('content'))} AS content FROM untidy", "untidy")


def digest(expr: str, source: str, *needs: str) -> str:
    return sql(
        f"SELECT path, length(t) AS chars, md5(t) AS digest FROM (SELECT path, {expr} AS t FROM {source})",
        *(needs or (source,)),
    )


def issue(level: str, code: str, message: str, identifier: str = "NULL") -> str:
    return f"SELECT '{level}' AS level, '{code}' AS code, {message} AS message, path AS file_path, CAST({identifier} AS VARCHAR) AS checkov_id"


def two(expr: str) -> str:
    return f"printf('%.2f', {expr})"


def structure_rules(p: str) -> list[str]:
    return [
        f"{issue('WARNING', 'NO_MATCHES', quote('No Checkov matches found in file'))}, 0 AS ord FROM {p}_docs WHERE n = 0",
        f"{issue('WARNING', 'LOW_CONFIDENCE', quote('Low confidence score: ') + ' || ' + two('confidence'))}, 1 AS ord FROM {p}_docs WHERE confidence < 0.3",
        f"{issue('WARNING', 'TOO_MANY_MATCHES', quote('Unusually high number of matches: ') + ' || n')}, 2 AS ord FROM {p}_docs WHERE n > 5",
    ]


def match_rules(p: str) -> list[str]:
    return [
        f"{issue('ERROR', 'INVALID_CHECKOV_ID', quote('Invalid Checkov ID format: ') + ' || checkov_id', 'checkov_id')}, 10 * rank AS ord FROM {p}_matches WHERE NOT regexp_matches(checkov_id, '{STRICT}')",
        f"{issue('WARNING', 'MISSING_SEVERITY', quote('No severity found for Checkov ID'), 'checkov_id')}, 10 * rank + 2 AS ord FROM {p}_matches WHERE severity IS NULL",
        f"{issue('WARNING', 'LOW_MATCH_CONFIDENCE', quote('Low match confidence: ') + ' || ' + two('confidence'), 'checkov_id')}, 10 * rank + 3 AS ord FROM {p}_matches WHERE confidence < 0.2",
    ]


def spread_rule(source: str) -> str:
    return (
        f"{issue('INFO', 'HIGH_CONFIDENCE_VARIATION', quote('High confidence variation: ') + ' || ' + two('spread'))}, 1000000 AS ord"
        f" FROM (SELECT path, max(confidence) - min(confidence) AS spread FROM {source} GROUP BY path) WHERE spread > 0.5"
    )


for _p in ("c", "pf"):
    cte(
        f"{_p}_issues",
        " UNION ALL ".join(structure_rules(_p) + match_rules(_p) + [spread_rule(f"{_p}_matches")]),
        f"{_p}_docs",
        f"{_p}_matches",
    )
ISSUE_COLUMNS = "level, code, message, file_path, checkov_id"


def new_issue(p: str) -> str:
    return f"{issue('INFO', 'NEW_CHECKOV_ID', quote('New Checkov ID not in existing database'), 'checkov_id')} FROM {p}_matches WHERE checkov_id NOT IN (SELECT checkov_id FROM existing_db) AND EXISTS (SELECT 1 FROM existing_db)"


NEW_ISSUE = new_issue("c")
MISMATCH_ISSUE = f"{issue('WARNING', 'SEVERITY_MISMATCH', quote('Severity mismatch: found ') + ' || severity || ' + quote(', database has ') + ' || existing', 'checkov_id')} FROM (SELECT m.*, e.severity AS existing FROM c_matches m JOIN existing_db e USING (checkov_id)) WHERE severity <> existing"


def result_view(p: str) -> str:
    return sql(
        f"""SELECT r.path, checkov_id, severity, raw_checkov_id, raw_severity, round(confidence, 6) AS confidence, content_hash, match_count, coalesce(codes, '') AS codes
FROM {p}_results r LEFT JOIN (SELECT file_path, string_agg(code, ',' ORDER BY ord) AS codes FROM {p}_issues GROUP BY file_path) i ON i.file_path = r.path""",
        f"{p}_results",
        f"{p}_issues",
    )


HIT_COLUMNS = "path, {} AS rank, checkov_id, round(confidence, 6) AS confidence, start_position, end_position, context, pattern_name"
SEQ = "row_number() OVER (PARTITION BY path ORDER BY seq)"
DOCUMENT = "SELECT path, coalesce(array_to_string(ids, ','), '') AS ids, coalesce(array_to_string(sevs, ','), '') AS severities, round(confidence, 6) AS confidence FROM {}_docs"


def declared(expr: str) -> str:
    return f"""(SELECT k, path, CASE k % 7 WHEN 1 THEN 'iso-8859-1' WHEN 2 THEN 'ascii' WHEN 4 THEN 'utf-16' WHEN 5 THEN 'utf-8-sig' ELSE 'utf-8' END AS encoding, {expr} FROM pages)"""


DECODED = f"""CASE k % 7 WHEN 6 THEN '' WHEN 1 THEN {PLAIN} || {quote(ACCENT)} WHEN 3 THEN {PLAIN} || chr(65533) || 't' || chr(65533) ELSE content END"""


def lines(head: str, entries: str, tail: str) -> str:
    """Lines of a document: head, entries with a comma on all but the first, tail."""
    return f"""SELECT 0 AS section, '' AS key, {head} AS line
UNION ALL SELECT 1, key, CASE WHEN row_number() OVER (ORDER BY key) = 1 THEN '' ELSE ',' END || line FROM ({entries})
UNION ALL SELECT 2, '', '{tail}'"""


ENTRIES = """SELECT checkov_id AS key, '"' || checkov_id || '":"' || severity || '"' AS line FROM mappings"""
COUNTS = """(SELECT '{' || string_agg('"' || severity || '":' || files, ',' ORDER BY severity) || '}' FROM agreeing)"""
N_MAPPINGS = "(SELECT count(*) FROM mappings)"
COMPACT_HEAD = f"""'{{"v":"1.0","t":"{STAMP}Z","c":' || {N_MAPPINGS} || ',"g":"1.0.0","s":{{'"""
DATABASE_HEAD = f"""'{{"metadata":{{"version":"1.0","timestamp":"{STAMP}Z","total_mappings":' || {N_MAPPINGS} || ',"generator_version":"1.0.0","extraction_stats":{{"total_mappings":'
  || (SELECT sum(files) FROM agreeing) || ',"severity_counts":' || {COUNTS} || '}}}},"export_metadata":{{"exported_at":"{STAMP}Z","format_version":"1.0","exported_by":"policyscan"}},"statistics":{{"total_mappings":'
  || {N_MAPPINGS} || ',"severity_breakdown":' || {COUNTS} || ',"confidence_metrics":{{"has_metadata":true,"has_timestamps":true,"completeness_score":1.0}}}},"mappings":{{'"""
NEW_PAIRS = """SELECT checkov_id, severity, arg_min(path, string_split(path, '/')) AS file_path FROM c_matches
WHERE severity IS NOT NULL AND checkov_id NOT IN (SELECT checkov_id FROM existing_db) GROUP BY checkov_id, severity"""
RESULT_LINES = """SELECT r.path, '{"file_path":' || to_json(r.path) || ',"confidence":' || to_json(round(r.confidence, 6)) || ',"matches":[' || coalesce(ms, '') || ']'
  || CASE WHEN iss IS NULL THEN '' ELSE ',"validation_issues":[' || iss || ']' END || '}' AS value
FROM c_results r LEFT JOIN (SELECT path, string_agg(to_json({'checkov_id': checkov_id, 'severity': severity, 'confidence': round(confidence, 6), 'pattern_name': pattern_name,
    'start_position': start_position, 'end_position': end_position, 'context': context}), ',' ORDER BY rank) AS ms FROM c_matches GROUP BY path) m USING (path)
LEFT JOIN (SELECT file_path AS path, string_agg(to_json({'severity': level, 'code': code, 'message': message, 'checkov_id': checkov_id}), ',' ORDER BY ord) AS iss FROM c_issues GROUP BY file_path) i USING (path)"""
RESULTS_HEAD = f"""(SELECT '{{"metadata":{{"total_files":' || total_files || ',"successful_extractions":' || files_with_matches || ',"generated_at":"{STAMP}Z","format_version":"1.0"}},"statistics":{{"total_files":'
  || total_files || ',"files_with_matches":' || files_with_matches || ',"total_matches":' || total_matches || ',"unique_checkov_ids":' || unique_ids
  || ',"average_confidence":' || mean || ',"min_confidence":' || low || ',"max_confidence":' || high || '}},"extraction_results":['
FROM (SELECT (SELECT count(*) FROM docs) AS total_files, count(*) FILTER (n > 0) AS files_with_matches, sum(n) AS total_matches, (SELECT count(DISTINCT checkov_id) FROM c_ids) AS unique_ids,
  round(avg(round(confidence, 6)) FILTER (confidence > 0), 6) AS mean, round(min(confidence) FILTER (confidence > 0), 6) AS low, round(max(confidence), 6) AS high FROM c_docs))"""
SUMMARY_HEAD = f"""(SELECT '{{"summary":{{"generated_at":"{STAMP}Z","database_entries":' || {N_MAPPINGS} || ',"processed_files":' || count(*) || ',"total_matches":' || sum(match_count)
  || '}},"database_summary":{{"severity_distribution":' || {COUNTS} || ',"last_updated":"{STAMP}","version":"1.0"}},"extraction_summary":{{"success_rate":'
  || round(count(*) FILTER (match_count > 0) / count(*), 6) || ',"average_confidence":' || round(avg(confidence) FILTER (match_count > 0), 6)
  || ',"validation_issues":' || (SELECT '{{' || string_agg('"' || level || '":' || n, ',' ORDER BY CASE level WHEN 'ERROR' THEN 0 WHEN 'WARNING' THEN 1 ELSE 2 END) || '}}' FROM (SELECT level, count(*) AS n FROM c_issues GROUP BY level))
  || ',"new_mappings":[' FROM c_results)"""

DOUBT_TOTAL = "(SELECT count(*) FROM orders)"
DOUBT_ISSUES = f"""SELECT 'ERROR' AS level, 'COUNT_MISMATCH' AS code, 'Metadata count mismatch: ' || ({DOUBT_TOTAL} + 1) || ' vs ' || {DOUBT_TOTAL} AS message, NULL::VARCHAR AS file_path, NULL::VARCHAR AS checkov_id
UNION ALL SELECT 'ERROR', 'INVALID_DB_CHECKOV_ID', 'Invalid Checkov ID in database: ' || checkov_id, NULL, checkov_id FROM doubtful WHERE NOT regexp_matches(checkov_id, '{STRICT}')
UNION ALL SELECT 'ERROR', 'INVALID_DB_SEVERITY', 'Invalid severity in database: ' || severity, NULL, checkov_id FROM doubtful WHERE severity NOT IN ({LEVELS})
UNION ALL SELECT 'INFO', 'SKEWED_DISTRIBUTION', 'Severity ' || severity || ' represents ' || printf('%.1f', share * 100) || '% of all entries', NULL, NULL
  FROM (SELECT severity, count(*) / sum(count(*)) OVER () AS share FROM doubtful WHERE severity IN ({LEVELS}) GROUP BY severity) WHERE share > 0.8"""
cte("doubt_issues", DOUBT_ISSUES, "doubtful")
DOUBT_SCORE = "greatest(0, least(1, 1.0 - 0.2 * e - 0.1 * w - 0.05 * i + 0.1))"
cte(
    "doubt_report",
    f"""SELECT e = 0 AS is_valid, e AS error_count, w AS warning_count, i AS info_count, CAST({DOUBT_SCORE} AS DOUBLE) AS confidence_score, {DOUBT_TOTAL} AS total_mappings
FROM (SELECT count(*) FILTER (level = 'ERROR') AS e, count(*) FILTER (level = 'WARNING') AS w, count(*) FILTER (level = 'INFO') AS i FROM doubt_issues)""",
    "doubt_issues",
)
QUALITY_HEAD = f"""(SELECT '{{"validation_summary":{{"is_valid":' || is_valid || ',"confidence_score":' || confidence_score || ',"total_issues":' || (error_count + warning_count + info_count)
  || ',"errors":' || error_count || ',"warnings":' || warning_count || ',"info":' || info_count || '}},"database_stats":{{"total_mappings":' || total_mappings
  || ',"severity_distribution":' || (SELECT '{{' || string_agg('"' || severity || '":' || n, ',' ORDER BY severity) || '}}' FROM (SELECT severity, count(*) AS n FROM doubtful GROUP BY severity))
  || ',"last_updated":"{STAMP}"}},"issues":[' FROM doubt_report)"""

RAW_MATCHES = f"""SELECT h.path, h.checkov_id, h.confidence, CASE WHEN d.m > 0 THEN d.sevs[(row_number() OVER (PARTITION BY h.path ORDER BY seq) - 1) % d.m + 1] END AS severity
FROM c_hits h JOIN c_docs d USING (path)"""
cte("raw_matches", RAW_MATCHES, "c_hits", "c_docs")
cte(
    "previous_run",
    f"SELECT path, {sha16(chr(39).join(['CASE WHEN o_orderstatus = ', 'O', ' THEN content || ', 'draft', ' ELSE content END']))} AS text_hash FROM docs WHERE mtime < '{EARLIER}'",
    "docs",
)
cte(
    "draft_docs",
    f"SELECT k, path, o_orderstatus, mtime, file_size, CASE WHEN o_orderstatus = 'O' THEN replace(content, '|Severity', '|Level') ELSE content END AS content FROM docs WHERE mtime < '{EARLIER}'",
    "docs",
)

CODES = r"CKV_[A-Z0-9]+_[0-9]+"

ORACLES: dict[str, str] = {
    # scans and reads
    "scan_recursive": sql(
        f"SELECT path, length FROM manifest WHERE NOT {DEFAULT_IGNORED} AND {DEPTH} <= 50 AND {EXTENSION} IN ('.adoc', '.asciidoc', '.asc', '.txt') AND length <= 10485",
        "manifest",
    ),
    "scan_single_level": sql(
        f"SELECT path, length FROM (SELECT regexp_replace(path, '^docs/[^/]+/', '') AS path, length FROM manifest) WHERE {DEPTH} = 0 AND NOT {DEFAULT_IGNORED} AND {EXTENSION} IN ('.adoc', '.txt')",
        "manifest",
    ),
    "scan_max_depth": sql(f"SELECT path, length FROM manifest WHERE {DEPTH} <= 2", "manifest"),
    "scan_ignore_globs": sql(
        "SELECT path FROM manifest WHERE NOT "
        + ignored(".*index.*", r".*policies\.adoc", ".*-polic.es", "[a-d].*er", "[^0-9]ode_mod.*"),
        "manifest",
    ),
    "scan_extension_filter": sql(
        f"SELECT path, {EXTENSION} AS extension FROM manifest WHERE {EXTENSION} = '.adoc'", "manifest"
    ),
    "scan_size_filter": sql("SELECT path, length FROM manifest WHERE length <= 5242", "manifest"),
    "scan_unreadable": sql("SELECT path FROM manifest WHERE NOT readable", "manifest"),
    "scan_counts": sql(
        f"""SELECT count(*) FILTER (ok) AS files_found, count(*) AS total_scanned, count(*) FILTER (NOT ok) AS filtered_out
FROM (SELECT {EXTENSION} = '.adoc' AND length <= 10485 AND readable AS ok FROM manifest WHERE NOT {PIPELINE_IGNORED})""",
        "manifest",
    ),
    "scan_multi_union": sql(
        "SELECT path, length FROM manifest WHERE path LIKE '%-policies/%' UNION SELECT path, length FROM manifest WHERE path LIKE '%/archive/%'",
        "manifest",
    ),
    "scan_path_order": sql("SELECT path FROM manifest ORDER BY string_split(path, '/')", "manifest"),
    "read_utf8_latin1": sql(
        "SELECT path, length(content) AS chars, md5(content) AS digest, file_size FROM read_files", "read_files"
    ),
    "read_with_encoding": sql(
        f"SELECT path, encoding, length(t) AS chars, md5(t) AS digest FROM (SELECT path, encoding, {newlines('t')} AS t FROM {declared(DECODED + ' AS t')})",
        "pages",
    ),
    "read_encoding_choice": sql(
        r"""SELECT path, CASE k % 7 WHEN 4 THEN 'utf-16' WHEN 5 THEN 'utf-8-sig' WHEN 6 THEN 'utf-8' WHEN 1 THEN 'utf-8' WHEN 3 THEN 'utf-8'
  ELSE CASE WHEN regexp_matches(content, '[^\x00-\x7f]') THEN 'utf-8' ELSE 'ascii' END END AS encoding FROM pages""",
        "pages",
    ),
    "read_batch": sql(
        "SELECT count(*) AS total_files, count(*) FILTER (readable) AS successful, count(*) FILTER (NOT readable) AS failed FROM manifest",
        "manifest",
    ),
    "db_read_compact": sql(
        """SELECT path, CASE WHEN k % 3 = 0 THEN '1.0' ELSE '2.0' END AS version, strftime(o_orderdate, '%Y-%m-%d') || ' 06:07:08' AS generated,
  CASE WHEN k % 3 = 0 THEN '1.0.0' ELSE '3.1' END AS generator_version, 2 AS total_mappings,
  'BC_' || prov || '_' || k || '=LOW,' || id || '=' || sev AS entries FROM keyed""",
        "keyed",
    ),
    "db_read_pieces": sql(
        "SELECT 'BC_' || prov || '_' || k AS checkov_id, 'LOW' AS severity FROM keyed UNION ALL SELECT id, sev FROM keyed", "keyed"
    ),
    # sinks
    "sink_database_json": sql(lines(DATABASE_HEAD, ENTRIES, "}}"), "mappings", "agreeing"),
    "sink_compact_json": sql(lines(COMPACT_HEAD, ENTRIES, "}}"), "mappings"),
    "sink_compact_size": sql(
        f"""SELECT octet_length(encode({COMPACT_HEAD} || (SELECT string_agg(line, ',') FROM ({ENTRIES})) || '}}}}')) AS compact_size_bytes""",
        "mappings",
    ),
    "sink_results_json": sql(RESULT_LINES, "c_results", "c_issues"),
    "sink_results_document": sql(
        lines(RESULTS_HEAD, f"SELECT path AS key, value AS line FROM ({RESULT_LINES})", "]}"),
        "c_results",
        "c_issues",
        "docs",
        "c_docs",
    ),
    "sink_summary_json": sql(
        lines(
            SUMMARY_HEAD,
            f"""SELECT file_path || '/' || checkov_id || '/' || severity AS key, to_json({{'checkov_id': checkov_id, 'severity': severity, 'file_path': file_path}}) AS line FROM ({NEW_PAIRS})""",
            "]}}",
        ),
        "mappings",
        "agreeing",
        "c_issues",
        "c_results",
        "existing_db",
    ),
    "sink_result_record": sql(
        """SELECT path AS file_path, checkov_id, severity, checkov_id IS NOT NULL AND severity IS NOT NULL AS success,
  array_to_string(errors, ';') AS errors, array_to_string(warnings, ';') AS warnings FROM noted""",
        "noted",
    ),
    # text
    "text_newlines": digest(newlines("content"), "untidy"),
    "text_rstrip_lines": digest("content", "lined"),
    "text_blank_collapse": digest(collapsed("content"), "lined"),
    "text_nfkc": digest(composed("content"), "untidy"),
    "text_strip_bom": digest("CASE WHEN content[1] = chr(65279) THEN content[2:] ELSE content END", "untidy"),
    "text_preprocess": sql(
        f"""SELECT path, length(t) AS chars, md5(t) AS digest, array_to_string(list_filter([
    CASE WHEN contains(original, chr(13)) THEN 'normalized_line_endings' END,
    CASE WHEN contains(content, repeat(chr(10), 4)) THEN 'reduced_excessive_blank_lines' END,
    CASE WHEN c <> {composed('c')} THEN 'unicode_normalization' END,
    CASE WHEN c[1] = chr(65279) THEN 'removed_bom' END], lambda x: x IS NOT NULL), ',') AS applied
FROM (SELECT *, CASE WHEN c[1] = chr(65279) THEN {composed('c')}[2:] ELSE {composed('c')} END AS t FROM (SELECT *, {collapsed('content')} AS c FROM lined))""",
        "lined",
    ),
    "text_profile": sql(
        r"""SELECT path, length(content) AS chars, len(string_split(content, chr(10))) AS lines,
  length(regexp_replace(content, '[\x00-\x7f]', '', 'g')) AS non_ascii_chars,
  length(content) - length(regexp_replace(content, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')) AS control_chars FROM untidy""",
        "untidy",
    ),
    "text_suitability": sql(
        rf"""SELECT path, length(content) >= 50 AND NOT noisy AS is_valid,
  array_to_string(list_filter([CASE WHEN length(content) < 50 THEN {quote(fixed.SUITABILITY_TOO_SHORT)} END, CASE WHEN noisy THEN {quote(fixed.SUITABILITY_CONTROL)} END,
    CASE WHEN len(words) = 0 THEN {quote(fixed.SUITABILITY_NO_KEYWORD)} END], lambda x: x IS NOT NULL), ';') AS issues,
  array_to_string(words, ',') AS relevant_keywords
FROM (SELECT path, content, list_filter([{", ".join(f"'{w}'" for w in fixed.RELEVANT_KEYWORDS)}], lambda w: contains(lower(content), w)) AS words,
  length(regexp_replace(content, '[^\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')) / greatest(length(content), 1) > 0.1 AS noisy FROM docs)""",
        "docs",
    ),
    "text_sha256_16": sql(f"SELECT path, {sha16('content')} AS content_hash FROM docs", "docs"),
    "text_match_context": sql(
        rf"""SELECT path, token, CASE WHEN length(ctx) > 100 THEN ctx[1:100] || '...' ELSE ctx END AS context
FROM (SELECT path, token, trim(regexp_replace(substr(content, greatest(spot - 50, 0) + 1, spot + length(token) + 50 - greatest(spot - 50, 0)), '[{SPACE}]+', ' ', 'g')) AS ctx
  FROM (SELECT path, content, token, instr(content, token) - 1 AS spot FROM (SELECT path, content, regexp_extract(content, '\[[A-Z0-9_]+\]', 0) AS token FROM docs)) WHERE token <> '')""",
        "docs",
    ),
    "text_match_contexts": sql(
        rf"""SELECT path, token, CAST(spot AS INTEGER) AS start_position, CASE WHEN length(ctx) > 100 THEN ctx[1:100] || '...' ELSE ctx END AS context
FROM (SELECT path, token, spot, trim(regexp_replace(substr(content, greatest(spot - 50, 0) + 1, spot + length(token) + 50 - greatest(spot - 50, 0)), '[{SPACE}]+', ' ', 'g')) AS ctx
  FROM (SELECT path, content, token, CAST(sum(length(gap) + length(token)) OVER (PARTITION BY path ORDER BY i) AS BIGINT) - length(token) AS spot
    FROM (SELECT path, content, i, tokens[i] AS token, gaps[i] AS gap FROM (SELECT path, content, tokens, gaps, unnest(range(1, len(tokens) + 1)) AS i
      FROM (SELECT path, content, regexp_extract_all(content, '\[[A-Z0-9_]+\]') AS tokens, regexp_split_to_array(content, '\[[A-Z0-9_]+\]') AS gaps FROM docs)))))""",
        "docs",
    ),
    "id_parse": sql(
        f"""SELECT path, word, CASE WHEN ok THEN word END AS full_id, CASE WHEN ok THEN split_part(word, '_', 1) END AS type, CASE WHEN ok THEN split_part(word, '_', 2) END AS provider,
  CASE WHEN ok THEN regexp_replace(word, '^[^_]*_[^_]*_', '') END AS number
FROM (SELECT *, regexp_matches(word, '{STRICT}') AS ok FROM (SELECT DISTINCT path, unnest(regexp_extract_all(content, '([A-Z0-9]+_[A-Z0-9_]+)', 1)) AS word FROM docs))""",
        "docs",
    ),
    "id_accept": sql(
        f"SELECT path, id AS word, {ACCEPTED} AS accepted FROM (SELECT DISTINCT path, unnest(regexp_extract_all(content, '([A-Z0-9_]{{2,}})', 1)) AS id FROM docs)",
        "docs",
    ),
    "id_type_provider_dim": sql(
        f"""SELECT path, checkov_id, split_part(checkov_id, '_', 1) AS id_type, split_part(checkov_id, '_', 2) AS provider, p.provider_name, p.provider_name IS NOT NULL AS is_known
FROM found LEFT JOIN (VALUES {", ".join(f"('{n}', '{c}')" for n, c in fixed.PROVIDERS.items())}) p(provider_name, code) ON p.code = split_part(checkov_id, '_', 2)""",
        "found",
    ),
    "severity_parse": f"SELECT o_orderkey, o_orderpriority[3:] AS word, CASE WHEN o_orderpriority[3:] IN ({LEVELS}) THEN o_orderpriority[3:] END AS severity FROM orders",
    "severity_rank": sql(f"SELECT checkov_id, severity, {RANK.format('severity')} AS rank FROM mappings", "mappings"),
    "error_category": sql("SELECT path, message, category FROM notes", "notes"),
    "result_flags": sql(
        "SELECT path, checkov_id IS NOT NULL AND severity IS NOT NULL AS success, len(errors) > 0 AS has_errors, len(warnings) > 0 AS has_warnings FROM noted",
        "noted",
    ),
    # filters
    "filter_empty": sql(f"SELECT path FROM docs WHERE NOT {NONBLANK}", "docs"),
    "filter_min_length": sql("SELECT path FROM docs WHERE length(content) < 50", "docs"),
    "filter_keywords": sql(f"SELECT path FROM docs WHERE {KEYWORD}", "docs"),
    "filter_binary": sql(f"SELECT path FROM docs WHERE {BINARY}", "docs"),
    "filter_process_gate": sql(f"SELECT path, {GATE} AS passed FROM docs", "docs"),
    "db_get": sql("SELECT * FROM mappings WHERE checkov_id = 'CKV_AZURE_1'", "mappings"),
    "db_filter_severity": sql("SELECT * FROM mappings WHERE severity = 'HIGH'", "mappings"),
    "db_filter_provider": sql("SELECT * FROM mappings WHERE contains(checkov_id, '_DOCKER_')", "mappings"),
    # extraction
    "extract_ids": sql(f"SELECT {HIT_COLUMNS.format('rank')} FROM c_ids", "c_ids"),
    "extract_ids_builtin": sql(f"SELECT {HIT_COLUMNS.format('rank')} FROM b_ids", "b_ids"),
    "extract_first_per_strong_pattern": sql(
        f"SELECT path, {SEQ} AS rank, checkov_id, pattern_name, start_position FROM c_hits", "c_hits"
    ),
    "match_confidence": sql(
        f"SELECT path, {SEQ} AS rank, checkov_id, pattern_name, round(confidence, 6) AS confidence FROM b_hits", "b_hits"
    ),
    "dedup_matches": sql(
        "SELECT path, place AS slot, checkov_id, round(confidence, 6) AS confidence, pattern_name FROM c_ids", "c_ids"
    ),
    "rank_matches": sql("SELECT path, rank, checkov_id, round(confidence, 6) AS confidence FROM c_ids", "c_ids"),
    "extract_severities": sql("SELECT path, pos, severity FROM c_sevs", "c_sevs"),
    "extract_severities_builtin": sql("SELECT path, pos, severity FROM b_sevs", "b_sevs"),
    "overall_confidence": sql("SELECT path, round(confidence, 6) AS confidence FROM c_docs", "c_docs"),
    "extract_document": sql(DOCUMENT.format("c"), "c_docs"),
    "extract_document_builtin": sql(DOCUMENT.format("b"), "b_docs"),
    "pair_positional": sql("SELECT path, rank, checkov_id, severity FROM c_matches", "c_matches"),
    "pair_nearest": sql(
        "SELECT i.path, i.rank, i.checkov_id, n.severity FROM c_ids i JOIN c_near n USING (path, rank)", "c_ids", "c_near"
    ),
    "primary_mapping": sql(
        "SELECT path, raw_checkov_id, raw_severity, checkov_id, severity, provider FROM c_results", "c_results"
    ),
    "process_document": result_view("c"),
    "process_batch": result_view("pf"),
    # joins
    "known_id_anti": sql(f"SELECT {ISSUE_COLUMNS}, NULL::VARCHAR AS context FROM ({NEW_ISSUE})", "c_matches", "existing_db"),
    "severity_mismatch_join": sql(
        "SELECT m.path, m.rank, m.checkov_id, m.severity, e.severity AS existing_severity FROM c_matches m JOIN existing_db e USING (checkov_id) WHERE m.severity <> e.severity",
        "c_matches",
        "existing_db",
    ),
    "new_mappings_anti": sql(NEW_PAIRS, "c_matches", "existing_db"),
    "db_merge": sql(
        "SELECT * FROM mappings UNION ALL SELECT * FROM second_db WHERE checkov_id NOT IN (SELECT checkov_id FROM mappings)",
        "mappings",
        "second_db",
    ),
    "db_merge_added": sql(
        "SELECT count(*) AS added FROM second_db WHERE checkov_id NOT IN (SELECT checkov_id FROM mappings)", "mappings", "second_db"
    ),
    "db_add": sql("SELECT * FROM mappings UNION ALL SELECT 'CKV_NEW_1', 'LOW'", "mappings"),
    "db_remove": sql(
        "SELECT * FROM mappings WHERE checkov_id NOT IN (SELECT id FROM keyed WHERE o_orderpriority = '1-URGENT')", "mappings", "keyed"
    ),
    "conflict_join": sql(
        "SELECT checkov_id, existing AS existing_severity, severity AS new_severity, path AS file_path FROM firsts WHERE severity <> existing",
        "firsts",
    ),
    # aggregates
    "mappings_first_wins": sql("SELECT * FROM mappings", "mappings"),
    "extraction_stats": sql("SELECT severity, files AS file_count FROM agreeing", "agreeing"),
    "db_assemble": sql(
        f"SELECT '1.0' AS version, sum(ids) AS total_mappings, '1.0.0' AS generator_version, sum(files) AS stats_total, {COUNTS} AS severity_counts FROM agreeing",
        "agreeing",
    ),
    "db_statistics": sql("SELECT severity, count(*) AS mapping_count FROM mappings GROUP BY severity", "mappings"),
    "severity_percentages": sql(
        "SELECT severity, round(count(*) / sum(count(*)) OVER () * 100, 6) AS percentage FROM mappings GROUP BY severity", "mappings"
    ),
    "most_common_severity": sql(
        "SELECT existing AS severity, count(DISTINCT checkov_id) AS mapping_count FROM firsts GROUP BY existing ORDER BY 2 DESC, min(string_split(path, '/')) LIMIT 1",
        "firsts",
    ),
    "result_statistics": sql(
        """SELECT (SELECT count(*) FROM docs) AS total_files, count(*) FILTER (n > 0) AS files_with_matches, sum(n) AS total_matches, (SELECT count(DISTINCT checkov_id) FROM c_ids) AS unique_checkov_ids,
  round(avg(confidence) FILTER (confidence > 0), 6) AS average_confidence, round(min(confidence) FILTER (confidence > 0), 6) AS min_confidence, round(max(confidence), 6) AS max_confidence FROM c_docs""",
        "docs",
        "c_docs",
    ),
    "summary_rates": sql(
        """SELECT count(*) AS processed_files, sum(match_count) AS total_matches, round(count(*) FILTER (match_count > 0) / count(*), 6) AS success_rate,
  round(avg(confidence) FILTER (match_count > 0), 6) AS average_confidence FROM c_results""",
        "c_results",
    ),
    "issue_counts": sql("SELECT level, count(*) AS issue_count FROM c_issues GROUP BY level", "c_issues"),
    "processing_summary": sql(
        """SELECT count(*) FILTER (passed) AS files_processed, count(*) FILTER (match_count > 0) AS successful_extractions, (SELECT count(*) FROM manifest WHERE NOT readable) AS failed_extractions,
  round(count(*) FILTER (match_count > 0) / count(*) FILTER (passed), 6) AS success_rate, sum(match_count) AS total_matches,
  round(avg(confidence) FILTER (match_count > 0), 6) AS average_confidence FROM f_results""",
        "f_results",
    ),
    "extraction_summary": sql(
        """SELECT count(DISTINCT checkov_id) AS total_mappings, count(*) FILTER (severity <> existing) AS duplicate_conflicts, (SELECT count(*) FROM manifest WHERE NOT readable) AS processing_errors,
  (SELECT string_agg('Cannot read ' || path, ';' ORDER BY string_split(path, '/')) FROM (SELECT path FROM manifest WHERE NOT readable ORDER BY string_split(path, '/') LIMIT 10)) AS errors,
  coalesce((SELECT string_agg(checkov_id || '|' || existing || '|' || severity || '|' || path, ';' ORDER BY string_split(path, '/'))
   FROM (SELECT * FROM firsts WHERE severity <> existing ORDER BY string_split(path, '/') LIMIT 10)), '') AS conflicts FROM firsts""",
        "firsts",
        "manifest",
    ),
    "run_statistics": sql(
        """SELECT count(*) AS total_files_found, count(*) AS total_files_processed, count(*) FILTER (ok) AS successful_extractions, count(*) FILTER (NOT ok) AS failed_extractions,
  round(count(*) FILTER (ok) * 100 / count(*), 2) AS success_rate_percent, round(count(*) FILTER (NOT ok) * 100 / count(*), 2) AS error_rate_percent,
  count(*) FILTER (len(errors) > 0) AS files_with_errors, count(*) FILTER (len(warnings) > 0) AS files_with_warnings, sum(file_size) AS total_bytes_processed,
  round(avg(file_size), 2) AS average_file_size_bytes, max(file_size) AS largest_file_bytes, min(file_size) AS smallest_file_bytes
FROM (SELECT *, checkov_id IS NOT NULL AND severity IS NOT NULL AS ok FROM noted)""",
        "noted",
    ),
    "provider_counts": sql(
        "SELECT split_part(checkov_id, '_', 2) AS provider, count(*) AS file_count FROM found GROUP BY 1", "found"
    ),
    "pattern_counts": sql("SELECT pattern_name, count(*) AS match_count FROM c_ids GROUP BY 1", "c_ids"),
    "error_category_counts": sql("SELECT category, count(*) AS error_count FROM notes GROUP BY 1", "notes"),
    "throughput": sql(
        """SELECT (SELECT count(*) FROM manifest) AS total_files_found, count(*) AS files_read, (SELECT count(*) FROM manifest WHERE NOT readable) AS files_failed, count(*) AS total_files_processed,
  count(*) FILTER (checkov_id IS NOT NULL AND severity IS NOT NULL) AS successful_extractions, count(*) FILTER (checkov_id IS NULL OR severity IS NULL) AS failed_extractions,
  count(*) FILTER (match_count > 0) AS files_with_matches, sum(match_count)::BIGINT AS total_matches, (SELECT sum(length) FROM manifest WHERE readable)::BIGINT AS total_bytes_processed, true AS rates_agree FROM f_results""",
        "f_results",
        "manifest",
    ),
    "statistics_report": sql(
        """SELECT section, name, CAST(value AS DOUBLE) AS value FROM (
SELECT 'extraction_summary' AS section, 'total_files_processed' AS name, count(*) AS value FROM noted
UNION ALL SELECT 'extraction_summary', 'total_files_found', (SELECT count(*) FROM orders)
UNION ALL SELECT 'extraction_summary', 'success_rate_percent', round((SELECT count(*) FROM found) * 100 / count(*), 2) FROM noted
UNION ALL SELECT 'extraction_summary', 'error_rate_percent', round((count(*) - (SELECT count(*) FROM found)) * 100 / count(*), 2) FROM noted
UNION ALL SELECT 'data_summary', 'average_file_size_bytes', round(sum(file_size) / count(*) FILTER (file_size > 0), 2) FROM noted
UNION ALL SELECT 'extraction_summary', 'successful_extractions', (SELECT count(*) FROM found)
UNION ALL SELECT 'extraction_summary', 'failed_extractions', count(*) - (SELECT count(*) FROM found) FROM noted
UNION ALL SELECT 'data_summary', 'total_bytes_processed', sum(file_size) FROM noted
UNION ALL SELECT 'data_summary', 'sized_files', count(*) FILTER (file_size > 0) FROM noted
UNION ALL SELECT 'data_summary', 'total_mappings_extracted', (SELECT count(*) FROM found)
UNION ALL SELECT 'quality_metrics', 'files_with_errors', count(*) FILTER (len(errors) > 0) FROM noted
UNION ALL SELECT 'quality_metrics', 'files_with_warnings', count(*) FILTER (len(warnings) > 0) FROM noted
UNION ALL SELECT 'severity_distribution', severity, count(*) FROM found GROUP BY severity
UNION ALL SELECT 'provider_distribution', split_part(checkov_id, '_', 2), count(*) FROM found GROUP BY 2
UNION ALL SELECT 'pattern_match_counts', pattern_name, count(*) FROM c_ids GROUP BY pattern_name
UNION ALL SELECT 'error_categories', category, count(*) FROM notes GROUP BY category)""",
        "noted",
        "found",
        "c_ids",
        "notes",
    ),
    "db_confidence_metrics": sql(
        "SELECT true AS has_metadata, true AS has_timestamps, CAST(CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS DOUBLE) AS completeness_score FROM mappings",
        "mappings",
    ),
    # quality
    "dq_structure": sql(f"SELECT {ISSUE_COLUMNS} FROM ({' UNION ALL '.join(structure_rules('c'))})", "c_docs"),
    "dq_match": sql(
        f"SELECT {ISSUE_COLUMNS} FROM ({' UNION ALL '.join(match_rules('b'))}) UNION ALL SELECT {ISSUE_COLUMNS} FROM ({new_issue('b')})",
        "b_matches",
        "existing_db",
    ),
    "dq_match_report": sql(
        f"""SELECT path, rank, checkov_id, e = 0 AS is_valid, e AS error_count, w AS warning_count, CAST(0 AS BIGINT) AS info_count, round(confidence, 6) AS confidence_score
FROM (SELECT *, CASE WHEN regexp_matches(checkov_id, '{STRICT}') THEN 0 ELSE 1 END AS e, CASE WHEN severity IS NULL THEN 1 ELSE 0 END + CASE WHEN confidence < 0.2 THEN 1 ELSE 0 END AS w FROM c_matches)""",
        "c_matches",
    ),
    "dq_duplicates": sql(
        """SELECT CASE WHEN len(ss) > 1 THEN 'ERROR' ELSE 'WARNING' END AS level, CASE WHEN len(ss) > 1 THEN 'CONFLICTING_SEVERITIES' ELSE 'DUPLICATE_CHECKOV_ID' END AS code,
  CASE WHEN len(ss) > 1 THEN 'Conflicting severities for ' || checkov_id || ': ' || array_to_string(ss, ', ') ELSE 'Duplicate Checkov ID found: ' || checkov_id END AS message, path AS file_path, checkov_id
FROM (SELECT path, checkov_id, count(*) AS n, coalesce(list(DISTINCT severity ORDER BY severity) FILTER (severity IS NOT NULL), []) AS ss FROM raw_matches GROUP BY path, checkov_id) WHERE n > 1""",
        "raw_matches",
    ),
    "dq_confidence_spread": sql(f"SELECT {ISSUE_COLUMNS} FROM ({spread_rule('raw_matches')})", "raw_matches"),
    "dq_against_db": sql(f"SELECT {ISSUE_COLUMNS} FROM ({MISMATCH_ISSUE})", "c_matches", "existing_db"),
    "dq_result": sql(
        f"SELECT {ISSUE_COLUMNS} FROM c_issues UNION ALL SELECT {ISSUE_COLUMNS} FROM ({NEW_ISSUE}) UNION ALL SELECT {ISSUE_COLUMNS} FROM ({MISMATCH_ISSUE})",
        "c_issues",
        "existing_db",
    ),
    "dq_db_metadata": sql(
        f"""SELECT 'WARNING' AS level, 'MISSING_VERSION' AS code, 'Database missing version information' AS message, NULL::VARCHAR AS file_path, NULL::VARCHAR AS checkov_id
UNION ALL SELECT 'ERROR', 'COUNT_MISMATCH', 'Metadata count mismatch: ' || (SELECT count(*) FROM orders) || ' vs ' || {N_MAPPINGS}, NULL, NULL WHERE (SELECT count(*) FROM orders) <> {N_MAPPINGS}""",
        "mappings",
    ),
    "dq_db_mapping": sql(f"SELECT {ISSUE_COLUMNS} FROM doubt_issues WHERE code LIKE 'INVALID%'", "doubt_issues"),
    "dq_db_skew": sql(f"SELECT {ISSUE_COLUMNS} FROM doubt_issues WHERE code LIKE 'SKEWED%'", "doubt_issues"),
    "dq_db_confidence": sql(
        f"""SELECT part, e = 0 AS is_valid, e AS error_count, 0 AS warning_count, i AS info_count, total_mappings,
  round(greatest(0, least(1, 1.0 - 0.2 * e - 0.05 * i + 0.1)), 6)::DOUBLE AS confidence_score
FROM (SELECT part, (sum(bad) + coalesce(sum(n) FILTER (level IS NULL), 0))::BIGINT AS e, sum(n)::BIGINT AS total_mappings,
    coalesce(max(n) FILTER (level IS NOT NULL) / sum(n) FILTER (level IS NOT NULL) > 0.8, false)::INT AS i
  FROM (SELECT split_part(checkov_id, '_', 2) AS part, CASE WHEN severity IN ({LEVELS}) THEN severity END AS level, count(*) AS n,
      count(*) FILTER (NOT regexp_matches(checkov_id, '{STRICT}')) AS bad FROM doubtful GROUP BY 1, 2) GROUP BY part)""",
        "doubtful",
    ),
    "dq_report": sql(
        """SELECT r.path, coalesce(e, 0) = 0 AS is_valid, coalesce(e, 0) AS error_count, coalesce(w, 0) AS warning_count, coalesce(i, 0) AS info_count, round(confidence, 6) AS confidence_score
FROM c_results r LEFT JOIN (SELECT file_path, count(*) FILTER (level = 'ERROR') AS e, count(*) FILTER (level = 'WARNING') AS w, count(*) FILTER (level = 'INFO') AS i FROM c_issues GROUP BY file_path) x ON x.file_path = r.path""",
        "c_results",
        "c_issues",
    ),
    "dq_report_by_code": sql(
        """SELECT code, count(*) FILTER (level = 'ERROR') = 0 AS is_valid, count(*) FILTER (level = 'ERROR') AS error_count, count(*) FILTER (level = 'WARNING') AS warning_count,
  count(*) FILTER (level = 'INFO') AS info_count, CAST(0 AS DOUBLE) AS confidence_score FROM c_issues GROUP BY code""",
        "c_issues",
    ),
    "dq_db_validate": sql("SELECT * REPLACE (round(confidence_score, 6) AS confidence_score) FROM doubt_report", "doubt_report"),
    "dq_quality_report": sql(
        lines(
            QUALITY_HEAD,
            """SELECT concat_ws('/', code, checkov_id, message) AS key, to_json({'severity': level, 'code': code, 'message': message, 'checkov_id': checkov_id, 'file_path': file_path}) AS line FROM doubt_issues""",
            "]}",
        ),
        "doubt_report",
        "doubtful",
    ),
    "db_integrity": sql(f"SELECT count(*) = {DOUBT_TOTAL} AND count(*) FILTER (severity NOT IN ({LEVELS})) = 0 AS is_consistent FROM doubtful", "doubtful"),
    # sorted lists
    "topk_providers": sql(
        """SELECT split_part(checkov_id, '_', 2) AS provider, count(*) AS file_count, round(count(*) / (SELECT count(*) FROM found) * 100, 6) AS percentage
FROM found GROUP BY 1 ORDER BY 2 DESC, min(string_split(path, '/')) LIMIT 10""",
        "found",
    ),
    "severity_distribution_sorted": sql(
        "SELECT severity, count(*) AS mapping_count, round(count(*) / sum(count(*)) OVER () * 100, 6) AS percentage FROM mappings GROUP BY severity",
        "mappings",
    ),
    "error_categories_sorted": sql("SELECT category, count(*) AS error_count FROM notes GROUP BY 1 ORDER BY 2 DESC, 1", "notes"),
    "limit_first_10": sql(
        """(SELECT checkov_id, existing AS existing_severity, severity AS new_severity, path AS file_path, 'conflict' AS kind, NULL::VARCHAR AS error FROM firsts WHERE severity <> existing ORDER BY string_split(path, '/') LIMIT 10)
UNION ALL (SELECT NULL, NULL, NULL, path, 'error', 'Cannot read ' || path FROM manifest WHERE NOT readable ORDER BY string_split(path, '/') LIMIT 10)""",
        "firsts",
        "manifest",
    ),
    # incremental work and hooks
    "incremental_changed": sql(
        f"""SELECT path, now AS text_hash FROM (SELECT path, now, CASE WHEN mtime < '{EARLIER}' THEN CASE WHEN o_orderstatus = 'O' THEN {sha16("content || 'draft'")} ELSE now END END AS before
  FROM (SELECT *, {sha16('content')} AS now FROM docs)) WHERE before IS NULL OR before <> now""",
        "docs",
    ),
    "incremental_listing": sql(
        """SELECT coalesce(n.path, t.path) AS path, CASE WHEN t.path IS NULL THEN 'new' WHEN n.path IS NULL THEN 'removed' ELSE 'edited' END AS change
FROM (SELECT path, octet_length(encode(content)) AS length FROM docs WHERE k % 11 <> 0) n
FULL JOIN (SELECT path, octet_length(encode(content)) AS length FROM draft_docs) t ON n.path = t.path WHERE n.path IS NULL OR t.path IS NULL OR n.length <> t.length""",
        "docs",
        "draft_docs",
    ),
    "custom_validator": sql(
        "SELECT 'ERROR' AS level, 'URGENT' AS code, 'Critical: ' || checkov_id AS message, path AS file_path, checkov_id FROM c_results WHERE severity = 'CRITICAL' AND checkov_id IS NOT NULL",
        "c_results",
    ),
    "read_report": sql(
        f"""SELECT path, encoding, length(t) AS chars, md5(t) AS digest, array_to_string(list_filter([
    CASE WHEN contains(s, repeat(chr(10), 4)) THEN 'reduced_excessive_blank_lines' END,
    CASE WHEN c <> {composed('c')} THEN 'unicode_normalization' END,
    CASE WHEN c[1] = chr(65279) THEN 'removed_bom' END], lambda x: x IS NOT NULL), ',') AS applied
FROM (SELECT *, CASE WHEN c[1] = chr(65279) THEN {composed('c')}[2:] ELSE {composed('c')} END AS t FROM (SELECT *, {collapsed('s')} AS c FROM (SELECT *, {stripped(newlines('raw'))} AS s FROM (
  SELECT path, CASE k % 7 WHEN 4 THEN 'utf-16' WHEN 5 THEN 'utf-8-sig' WHEN 6 THEN 'utf-8' WHEN 1 THEN 'utf-8' WHEN 3 THEN 'utf-8'
    ELSE CASE WHEN regexp_matches(content, '[^\\x00-\\x7f]') THEN 'utf-8' ELSE 'ascii' END END AS encoding,
    CASE WHEN k % 7 IN (1, 3) THEN {PLAIN} || chr(65533) || 't' || chr(65533) WHEN k % 7 = 6 THEN '' ELSE content END AS raw FROM pages))))""",
        "pages",
    ),
    # The refreshed table must equal the one made from scratch.
    "incremental_refresh": sql("SELECT * FROM mappings", "mappings"),
    "custom_patterns": sql(DOCUMENT.format("u"), "u_docs"),
}
ORACLES["conflicts"] = ORACLES["conflict_join"]
ORACLES["custom_matcher"] = sql(
    rf"""SELECT path, rank, checkov_id, CASE WHEN m = 0 THEN NULL WHEN rank <= m THEN sevs[rank] WHEN m = 1 THEN sevs[1] ELSE near END AS severity, start_position, end_position
FROM (SELECT x.*, d.m, d.sevs, (SELECT arg_min(s.severity, least(
      CASE WHEN instr(reverse(substr(lower(d.content), 1, start_position + length(s.severity))), reverse(lower(s.severity))) > 0
        THEN instr(reverse(substr(lower(d.content), 1, start_position + length(s.severity))), reverse(lower(s.severity))) + length(s.severity) - 1 - length(s.severity) END,
      CASE WHEN instr(substr(lower(d.content), start_position + 2), lower(s.severity)) > 0 THEN instr(substr(lower(d.content), start_position + 2), lower(s.severity)) END) * 10 + s.pos)
    FROM c_sevs s WHERE s.path = x.path) AS near
  FROM (SELECT path, checkov_id, row_number() OVER (PARTITION BY path ORDER BY end_position) AS rank, end_position - length(checkov_id) AS start_position, end_position
    FROM (SELECT path, m AS checkov_id, tail, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY path ORDER BY ord) AS BIGINT) AS end_position
      FROM (SELECT path, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap, unnest(gaps[2:]) AS tail, unnest(range(1, len(ms) + 1)) AS ord
        FROM (SELECT path, regexp_extract_all(content, '{CODES}', 0) AS ms, regexp_split_to_array(content, '{CODES}') AS gaps FROM c_live)))
    WHERE NOT regexp_matches(tail, '^[0-9A-Z_]')) x JOIN c_docs d USING (path))""",
    "c_docs",
    "c_sevs",
    "c_live",
)
