"""Site-relative line frequency: lines that many pages of one site share are dropped.

For every site, the pages containing a line are counted and divided by the pages of the
site; lines above the boilerplate ratio leave every page of that site.  DataFrame
functions only.

Each page brings each of its lines once, as a 64-bit hash, so the counts combine before
the shuffle and a hot site or a hot line costs one row per task; no text is shuffled for
them.  The frequent lines of a site are at most (lines per page) / (ratio), so one array
per site holds them.  These arrays are written once and joined to the pages by the
written size: broadcast while small, else a shuffle by site whose skewed partitions are
split, as both of its inputs are plain scans.

Defined results
    null or empty text: no lines; the text comes back as empty text
    null site: the rows without a site are one site
    lines are compared without the white space around them; lines without a word stay
    repeated rows: each row is a page of its own, as in the SQL; with ``copies_once`` (the
    pipeline's ``clean``) rows of one site with equal texts count as one page, in the
    line counts and in the site's total, so copies do not make each other boilerplate
    lines in fewer than ``min_pages`` pages of a site stay
    near copies (``copy_share``, in the pipeline's ``clean``): a page of whose worded lines
    that share or more is frequent is a copy of other pages rather than their frame, and
    comes back as it is; the near-dup stage then keeps one of the group
    extra input columns: kept apart from the working columns, whatever their names
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policyscan.session import stage

BOILERPLATE_RATIO = 0.05
MIN_PAGES = 3
COPY_SHARE = 0.8

SPACES = r"' \t\n\u000B\u000C\r'"


def _key(line: str) -> str:
    return f"xxhash64(trim(BOTH {SPACES} FROM {line}))"


def _has_word(line: str) -> str:
    return f"length(trim(BOTH {SPACES} FROM {line})) > 0"


def frequent_lines(pages: DataFrame, ratio: float, min_pages: int, copies_once: bool = False) -> DataFrame:
    """One row per site with boilerplate: the hashes of its lines above the ratio.

    ``pages`` has ``site``, ``lines`` (array of strings) and ``digest`` of the whole text.
    """
    keys = F.expr(f"array_distinct(transform(filter(lines, l -> {_has_word('l')}), l -> {_key('l')}))")
    keyed, counted_pages = pages.select("site", keys.alias("keys")), pages.select("site")
    if copies_once:
        # The copies of a text combine before the shuffle, which moves hashes only.
        keyed = pages.select("site", "digest", keys.alias("keys")).groupBy("site", "digest").agg(F.first("keys").alias("keys"))
        counted_pages = pages.select("site", "digest").distinct()
    totals = counted_pages.groupBy("site").agg(F.count(F.lit(1)).alias("n_pages"))
    counted = (
        keyed.select("site", F.explode("keys").alias("line"))
        .groupBy("site", "line")
        .agg(F.count(F.lit(1)).alias("n_with"))
        .filter(F.col("n_with") >= min_pages)
    )
    joined = counted.alias("c").join(totals.alias("t"), F.col("c.site").eqNullSafe(F.col("t.site")))
    above = joined.filter(F.col("n_with") > F.lit(float(ratio)) * F.col("n_pages"))
    return above.groupBy(F.col("c.site").alias("frequent_site")).agg(
        F.sort_array(F.collect_list("line")).alias("frequent")
    )


def dedup(
    docs: DataFrame,
    site_col: str = "source",
    text_col: str = "text",
    ratio: float = BOILERPLATE_RATIO,
    min_pages: int = MIN_PAGES,
    copies_once: bool = False,
    copy_share: float | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``row`` (a struct of its columns), n_lines, n_dropped, clean_text."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    pages = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{site_col}`").alias("site"),
        F.split(text, "\n", -1).alias("lines"),
        F.unhex(F.md5(F.encode(text, "UTF-8"))).alias("digest"),
    )
    counted = pages.select("site", "lines", "digest")
    frequent = stage(frequent_lines(counted, ratio, min_pages, copies_once), "frequent-lines")
    joined = pages.join(frequent, F.col("site").eqNullSafe(F.col("frequent_site")), "left")
    # Sites without boilerplate keep their lines as they are.
    judged = joined.withColumn(
        "stay",
        F.expr(
            "CASE WHEN frequent IS NULL THEN lines"
            f" ELSE filter(lines, l -> NOT ({_has_word('l')} AND array_contains(frequent, {_key('l')}))) END"
        ),
    )
    if copy_share is not None:
        worded = f"size(filter(lines, l -> {_has_word('l')}))"
        copied = f"size(lines) - size(stay) >= {float(copy_share)!r}D * {worded}"
        judged = judged.withColumn("stay", F.expr(f"CASE WHEN {copied} THEN lines ELSE stay END"))
    return judged.select(
        "row",
        F.expr(f"CAST(size(filter(lines, l -> {_has_word('l')})) AS bigint)").alias("n_lines"),
        (F.size("lines") - F.size("stay")).cast("long").alias("n_dropped"),
        F.array_join("stay", "\n").alias("clean_text"),
    )


def clean(docs: DataFrame, site_col: str = "source", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with boilerplate lines removed; ``n_chars`` is brought up to date.

    Rows of one site with equal texts count as one page, and near copies stay whole.
    """
    judged = dedup(docs, site_col, text_col, **({"copies_once": True, "copy_share": COPY_SHARE} | settings))
    values = {c: F.col("row")[c] for c in docs.columns}
    values[text_col] = F.col("clean_text")
    if "n_chars" in values:
        values["n_chars"] = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    return judged.select(*[v.alias(c) for c, v in values.items()])


def report(docs: DataFrame, id_col: str = "doc_id", site_col: str = "source", text_col: str = "text") -> DataFrame:
    """Id, site, line counts and cleaned text of every row."""
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.col(site_col).alias("source"), F.col(text_col).alias("text")
    )
    return dedup(narrow).select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("row.source").alias("source"),
        "n_lines",
        "n_dropped",
        F.col("clean_text").alias("text"),
    )


_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE = f"""
WITH pages AS (
  SELECT row_number() OVER () AS rid, doc_id, source, string_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents
), numbered AS (
  SELECT rid, source, i, ls[i] AS l, trim(ls[i], {_BLANK}) AS t
  FROM (SELECT rid, source, ls, unnest(range(1, len(ls) + 1)) AS i FROM pages)
), totals AS (
  SELECT source, count(*) AS n_pages FROM pages GROUP BY source
), frequent AS (
  SELECT c.source, c.t FROM (
    SELECT source, t, count(DISTINCT rid) AS n_with FROM numbered WHERE t <> '' GROUP BY source, t
  ) c JOIN totals ON c.source IS NOT DISTINCT FROM totals.source
  WHERE n_with >= {MIN_PAGES} AND n_with > {BOILERPLATE_RATIO}::DOUBLE * n_pages
), marked AS (
  SELECT n.rid, n.i, n.l, n.t, f.t IS NOT NULL AS dropped
  FROM numbered n LEFT JOIN frequent f ON n.source IS NOT DISTINCT FROM f.source AND n.t = f.t
), joined AS (
  SELECT rid, count(*) FILTER (t <> '') AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT dropped), '') AS text
  FROM marked GROUP BY rid
)
SELECT doc_id, source, n_lines::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, text
FROM pages JOIN joined USING (rid)
"""
