"""The policy corpus and its companions, derived from the driver's tables.

The tables hold prose but no policy pages.  Every order becomes one page: its key
decides the layout, its priority the severity, and a whole document is the prose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from policyscan.frames import compute_once
from policyscan.functions import sql
from policyscan.functions.text import newlines

PROVIDER_CYCLE = ["AWS", "AZURE", "GCP", "K8S", "GIT", "DOCKER", "ALI", "IBM", "OCI", "TF", "LIC", "SAST", "OPENAPI"]
NOISE = "\x01\x02\x03\x04" * 16

# Page layouts; {prose} is a whole document.
LINK = "|Checkov ID\n|https://example.test/rules/{id}.py[{id}]\n\n"
LAYOUTS = [
    "== Policy {k}\n\n" + LINK + "|Severity\n|{sev}\n\n{prose}\n",
    "== Policy {k}\n\n|Checkov ID\n|{id}\n\n|Severity\n|{sev}\n\n{prose}\n",
    "Checkov ID: {id}\nSeverity: {sev}\n\n{prose}\n",
    "{prose}\n\nFor details see [{id}].\n\n|Severity|{sev}\n",
    "| Checkov ID\n| https://example.test/rules/{id}.py[{id}]\n\n| Severity\n| {sev}\n\n{prose}\n",
    "|Checkov ID\n|{id}\n\n{prose}\n",
    "|Checkov ID\n|{id}\n\n|Severity\n|{mixed}\n\n{prose}\n",
    "[{id}] severity",
    "{prose}\n\n[{id}] is described on another page of this book.\n",
    "== Policy {k}\r\n\r\n" + LINK.replace("\n", "\r\n") + "|Severity\r\n|{sev}\r\n\r\n{prose}\r\n",
    "== Policy {k}\n\n" + LINK + "|Severity\n|{sev}\n\n{prose}\n\n"
    "|Checkov ID\n|https://example.test/rules/extra.py[CKV_AWS_{k}X]\n\n|Severity\n|{other}\n",
    "|Checkov ID\n|CKV2_AWS_FOO\n\n|Severity\n|{sev}\n\n{prose}\n\nSee also [{id}] here.\n",
    "severity notes\n|Severity\n|{sev}\n|Severity\n|{other}\n\n{prose}\n\n"
    "[{id}] [CKV_AWS_{k}Y]\n\n{prose}\n\nhighigh light [CKV_AWS_{k}Z]\n",
    "|Checkov ID\n|https://example.test/none\nnotes [NOTE] then [{id}]\n\n|Severity\n|{sev}\n\n{prose}\n",
    " \n\t\n",
    "severity [{id}]{noise}",
]
VARIANTS = len(LAYOUTS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CYCLE = "array(" + ", ".join(f"'{p}'" for p in PROVIDER_CYCLE) + ")"
_SEVERITY = """CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL' WHEN '2-HIGH' THEN 'HIGH'
  WHEN '3-MEDIUM' THEN 'MEDIUM' WHEN '5-LOW' THEN 'LOW' ELSE 'INFO' END"""
# Ingredients of a page, in SQL over the orders table.
FIELDS = {
    "k": "o_orderkey",
    "g": "o_orderkey div 3",
    "v": f"CAST(o_orderkey % {VARIANTS} AS INT)",
    "sev": _SEVERITY,
    "prov": f"{_CYCLE}[CAST((o_orderkey div 3) % {len(PROVIDER_CYCLE)} AS INT)]",
}
_ID = "concat('CKV_', prov, '_', g)"
_PATH = """concat('docs/', lower(prov), CASE WHEN k % 2 = 0 THEN '-policies/' ELSE '/' END,
  CASE WHEN k % 25 = 7 THEN 'node_modules/' WHEN k % 25 = 11 THEN '.cache/'
       WHEN k % 10 = 3 THEN 'archive/old/' ELSE '' END,
  CASE WHEN k % 50 = 0 THEN 'index' ELSE 'p' END, k,
  CASE WHEN k % 41 = 0 THEN '.txt' WHEN k % 37 = 0 THEN '.ADOC' ELSE '.adoc' END)"""


def keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with the ingredients of their pages: k, g, v, sev, prov, id and path."""
    orders = table(spark, sf_dir, "orders")
    fields = [f"{expression} AS {name}" for name, expression in FIELDS.items()]
    kept = ["o_orderstatus", "o_orderpriority", "o_orderdate"]
    return orders.selectExpr(*kept, *fields).selectExpr("*", f"{_ID} AS id", f"{_PATH} AS path")


def _layout_sql(layout: str) -> str:
    parts = {
        "id": "id",
        "sev": "sev",
        "other": "CASE WHEN sev = 'LOW' THEN 'HIGH' ELSE 'LOW' END",
        "mixed": "concat(substring(sev, 1, 1), lower(substring(sev, 2)))",
        "k": "k",
        "prose": "prose",
        "noise": sql.string(NOISE),
    }
    pieces = []
    for piece in layout.split("{"):
        name, closed, rest = piece.partition("}")
        pieces += [parts[name], sql.string(rest)] if closed else [sql.string(piece)]
    return f"concat({', '.join(pieces)})"


def _content_sql() -> str:
    cases = " ".join(f"WHEN {v} THEN {_layout_sql(x)}" for v, x in enumerate(LAYOUTS))
    return f"CASE v {cases} END"


def policy_pages(spark: SparkSession, sf_dir: str, chosen: DataFrame | None = None) -> DataFrame:
    """Every order as a page: path, content (as stored) and its ingredients.

    With ``chosen`` (path) only those pages are read: they are picked by their short rows,
    before a text is attached.
    """
    documents = table(spark, sf_dir, "documents").selectExpr("doc_id", "text AS prose")
    first = documents.select(F.min("doc_id")).scalar()
    count = documents.select(F.count("*")).scalar()
    # The texts dominate.  Orders are narrow and often one small file, so they are
    # spread before a text is attached to each of them; broadcasting them instead
    # would leave the texts in the few partitions their file was read in.
    spread = spark.sparkContext.defaultParallelism * 4
    keyed = keyed_orders(spark, sf_dir).withColumn("doc_id", first + F.col("k") % count)
    if chosen is not None:
        keyed = keyed.join(chosen.select("path"), "path", "left_semi")
    pages = keyed.repartition(spread, "doc_id").join(documents.hint("merge"), "doc_id")
    filled = compute_once(pages, content=F.expr(_content_sql()))
    return filled.selectExpr(
        "k",
        "g",
        "v",
        "sev",
        "prov",
        "id",
        "o_orderstatus",
        "o_orderdate AS modificationTime",
        "path",
        "content",
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents(path, content, file_size): the pages as the reader delivers them."""
    return compute_once(
        policy_pages(spark, sf_dir).select("path", "content"),
        content=newlines(F.col("content")),
        file_size=F.octet_length("content").cast("bigint"),
    )


def _plain(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x00-\x7f]+", "")


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as files: some cannot be read, some are Latin-1, the rest UTF-8."""
    k, text = F.col("k"), F.col("content")
    content = (
        F.when(k % 97 == 0, F.lit(None).cast("binary"))
        .when(
            k % 29 == 0,
            F.concat(F.encode(_plain(text), "UTF-8"), F.unhex(F.lit("E974E9"))),
        )
        .otherwise(F.encode(text, "UTF-8"))
    )
    files = policy_pages(spark, sf_dir).select(
        "k", "path", "modificationTime", content.alias("content")
    )
    return files.select(
        "k",
        "path",
        F.coalesce(F.octet_length("content"), F.lit(0)).cast("bigint").alias("length"),
        "modificationTime",
        "content",
    )


def declared_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as files with a declared encoding that may or may not fit."""
    k, text = F.col("k"), F.col("content")
    latin = F.concat(F.encode(_plain(text), "UTF-8"), F.unhex(F.lit("E974E9")))
    utf8 = F.encode(text, "UTF-8")
    marked = F.concat(F.unhex(F.lit("FFFE")), F.encode(text, "UTF-16LE"))
    signed = F.concat(F.unhex(F.lit("EFBBBF")), utf8)
    kind = k % 7
    return policy_pages(spark, sf_dir).select(
        "k",
        "path",
        F.when(kind == 1, latin)
        .when(kind == 3, latin)
        .when(kind == 4, marked)
        .when(kind == 5, signed)
        .when(kind == 6, F.lit(b""))
        .otherwise(utf8)
        .alias("content"),
        F.when(kind == 1, "iso-8859-1")
        .when(kind == 2, "ascii")
        .when(kind == 4, "utf-16")
        .when(kind == 5, "utf-8-sig")
        .otherwise("utf-8")
        .alias("encoding"),
    )


def untidy_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with what preprocessing cleans: blanks, empty lines, wide letters, a mark."""
    k, text = F.col("k"), F.col("content")
    untidy = (
        F.when(k % 5 == 0, F.concat(F.lit("Title  \t\n"), text, F.lit(" \n \n\n\t\n\nend  ")))
        .when(k % 5 == 1, F.concat(text, F.lit("\ufb01ne \uff21\u00a0\n")))
        .when(k % 5 == 2, F.concat(F.lit("\ufeff"), text))
        .otherwise(text)
    )
    return policy_pages(spark, sf_dir).select("k", "path", untidy.alias("content"))


def existing_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier database: identifiers of closed orders, severity of the smallest key."""
    closed = keyed_orders(spark, sf_dir).filter("o_orderstatus = 'F'")
    return closed.groupBy(F.col("id").alias("checkov_id")).agg(
        F.min_by("sev", "k").alias("severity")
    )


def second_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another database: identifiers of open orders, all MEDIUM."""
    open_orders = keyed_orders(spark, sf_dir).filter("o_orderstatus = 'O'")
    return open_orders.selectExpr("id AS checkov_id", "'MEDIUM' AS severity").distinct()


def deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers of urgent orders."""
    urgent = keyed_orders(spark, sf_dir).filter("o_orderpriority = '1-URGENT'")
    return urgent.selectExpr("id AS checkov_id").distinct()


def doubtful_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A database with flaws: malformed identifiers and unknown severities.

    The severity is INFO except for closed urgent orders (CRITICAL) and a few odd words.
    """
    return keyed_orders(spark, sf_dir).selectExpr(
        """CASE WHEN k % 400 = 1 THEN concat('CKV2_AWS_FOO', k, 'X')
           ELSE concat('CKV_', prov, '_', k) END AS checkov_id""",
        """CASE WHEN k % 500 = 2 THEN 'SEVERE'
           WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'CRITICAL'
           ELSE 'INFO' END AS severity""",
    )


def compact_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A compact database document per page: two good entries and one bad one.

    Every third document leaves out its version and generator.
    """
    entries = """concat('"s":{"', id, '":"', sev, '","BC_', prov, '_', k, '":"LOW","CKV_X_1":"low"}')"""
    time = "concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T06:07:08')"
    brief = f"""concat('{{"t":"', {time}, '",', {entries}, '}}')"""
    full = f"""concat('{{"v":"2.0","t":"', {time}, 'Z","c":9,"g":"3.1",', {entries}, '}}')"""
    return keyed_orders(spark, sf_dir).selectExpr(
        "path", f"CASE WHEN k % 3 = 0 THEN {brief} ELSE {full} END AS value"
    )
