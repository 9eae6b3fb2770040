"""Table-usage inventory over a table of SQL scripts.

Input: ``scripts(script_id string, text string)``, any number of rows (see
``read_scripts`` for a folder of .sql files).  Everything is native column
expressions — comment stripping with ``regexp_replace``, statement split
with ``split`` + ``posexplode``, reference extraction with
``regexp_extract_all`` + ``explode`` — followed by ordinary relational work
(distinct, pivot, grouped counts, a self-join per statement).  No grammar
parser: the patterns cover the statement shapes of T-SQL procedures
(FROM/JOIN/USING reads, comma lists with derived tables, INSERT INTO,
UPDATE with alias targets, DELETE FROM, MERGE [INTO] with its WHEN
branches and OUTPUT INTO, CTE names).

Rules: every FROM/JOIN/USING read -> ``select``; every target -> its verb; a
MERGE target -> ``merge`` plus one row per branch verb; CTE names are not
tables; names are compared without brackets, schema prefix or @link.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A table name: optional [schema]. parts, optional '#', optional @link.
NAME = r"(?:\[?\w+\]?\.)*\[?#{0,2}\w+\]?(?:@\w+)?"
ALIAS = r"(?:\s+(?:AS\s+)?(?!(?:WHERE|ON|INNER|LEFT|RIGHT|FULL|CROSS|JOIN|GROUP|ORDER|HAVING|UNION|SET|WHEN|OUTPUT|USING|VALUES|SELECT|AND|OR)\b)(\w+))?"
# FROM list up to the next clause keyword; one level of parentheses (derived tables) inside.
FROM_LIST = (r"(?is)(?<!\bDELETE )\bFROM\s+((?:[^;()]|\([^()]*(?:\([^()]*\)[^()]*)*\))+?)"
             r"(?=\s*(?:\bWHERE\b|\bGROUP\s+BY\b|\bORDER\s+BY\b|\bHAVING\b|\bUNION\b|\bINNER\b|\bLEFT\b|"
             r"\bRIGHT\b|\bFULL\b|\bCROSS\b|\bJOIN\b|\bON\b|\bWHEN\b|\bSET\b|\)|$))")
JOIN_REF = rf"(?is)\bJOIN\s+({NAME}){ALIAS}"
USING_REF = rf"(?is)\bUSING\s+({NAME}){ALIAS}"
TARGETS = {
    "insert": rf"(?is)\bINSERT\s+INTO\s+({NAME})",
    "update": rf"(?is)\bUPDATE\s+(?!SET\b)({NAME})",
    "delete": rf"(?is)\bDELETE\s+FROM\s+({NAME})",
    "merge": rf"(?is)\bMERGE\s+(?:INTO\s+)?({NAME})",
}
OUTPUT_INTO = rf"(?is)\bOUTPUT\b.*?\bINTO\s+({NAME})"
CTE_NAME = r"(?is)(?:\bWITH\s+|,\s*)(\w+)\s+AS\s*\("
MERGE_BRANCH = r"(?is)\bWHEN\s+(NOT\s+MATCHED(?:\s+BY\s+(?:TARGET|SOURCE))?|MATCHED)\b.*?\bTHEN\s+(UPDATE|INSERT|DELETE)"
SET_COLUMN = r"(?im)(?:^|\bSET\b|,)\s*(?:\w+\.)?(\w+)\s*=(?![=<>])"
SPLIT_TOP_COMMA = r",(?![^(]*\))"


def read_scripts(spark: SparkSession, path: str) -> DataFrame:
    """A folder (or glob) of .sql files as ``scripts(script_id, text)``, one row per file."""
    return (spark.read.text(path, wholetext=True)
            .select(F.input_file_name().alias("script_id"), F.col("value").alias("text")))


def _clean(text: Column) -> Column:
    """Drop comments and the contents of one-line string literals; the line count is unchanged.

    Block comments are cut out at their boundaries and replaced by their own
    newlines, so later statements keep their line numbers.
    """
    no_strings = F.regexp_replace(text, r"'[^'\n]*'", "''")
    pieces = F.split(no_strings, r"(?=/\*)|(?<=\*/)")
    no_block = F.array_join(F.transform(pieces, lambda p: F.when(
        p.startswith("/*"), F.regexp_replace(p, r"[^\n]", "")).otherwise(p)), "")
    return F.regexp_replace(no_block, r"--[^\n]*", "")


def _strip(c: Column) -> Column:
    """Trim all whitespace (``trim`` removes spaces only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _base_name(raw: Column) -> Column:
    """`[schema].[Name]@link` -> `Name`."""
    no_link = F.regexp_replace(raw, r"@\w+$", "")
    no_brackets = F.regexp_replace(no_link, r"[\[\]]", "")
    return F.element_at(F.split(no_brackets, r"\."), -1)


def statements(scripts: DataFrame) -> DataFrame:
    """One row per statement: script_id, stmt_id, text, first and last line."""
    parts = scripts.select("script_id", F.posexplode(F.split(_clean(F.col("text")), ";")).alias("stmt_id", "stmt"))
    # line numbers: newlines before the statement (running sum within the script)
    w = Window.partitionBy("script_id").orderBy("stmt_id").rowsBetween(Window.unboundedPreceding, -1)
    nl = F.size(F.split(F.col("stmt"), "\n")) - 1
    lead_nl = F.size(F.split(F.regexp_extract("stmt", r"^(\s*)", 1), "\n")) - 1
    trail_nl = F.size(F.split(F.regexp_extract("stmt", r"(\s*)$", 1), "\n")) - 1
    out = (parts.withColumn("nl", nl)
           .withColumn("before", F.coalesce(F.sum("nl").over(w), F.lit(0)))
           .withColumn("first_line", F.col("before") + lead_nl + 1)
           .withColumn("last_line", F.col("before") + F.col("nl") - trail_nl + 1)
           .filter(F.length(_strip(F.col("stmt"))) > 0))
    return out.select("script_id", "stmt_id", F.col("stmt").alias("text"), "first_line", "last_line")


def references(scripts: DataFrame) -> DataFrame:
    """Every table reference: script_id, stmt_id, type, raw, name, alias, role ('read'/'target'/'branch')."""
    st = statements(scripts)
    # FROM lists, split on top-level commas
    # the FROM of a DELETE names its target: one blank between the two tells it, however many there were
    deletes = F.regexp_replace("text", r"(?i)\bDELETE\s+FROM\b", "DELETE FROM")
    from_items = (st.select("script_id", "stmt_id", F.explode(F.regexp_extract_all(deletes, F.lit(FROM_LIST), 1)).alias("seg"))
                  .select("script_id", "stmt_id", F.explode(F.split("seg", SPLIT_TOP_COMMA)).alias("item"))
                  .select("script_id", "stmt_id", _strip(F.col("item")).alias("item"))
                  .filter(F.col("item") != ""))
    plain = from_items.filter(~F.col("item").startswith("("))
    from_refs = plain.select(
        "script_id", "stmt_id",
        F.regexp_extract("item", rf"(?is)^({NAME}){ALIAS}", 1).alias("raw"),
        F.regexp_extract("item", rf"(?is)^({NAME}){ALIAS}", 2).alias("alias"))
    # a derived table "(select ... from x) a" in a comma list: its inner FROM names are reads too
    derived_refs = (from_items.filter(F.col("item").startswith("("))
                    .select("script_id", "stmt_id",
                            F.explode(F.regexp_extract_all("item", F.lit(rf"(?is)\bFROM\s+({NAME})"), 1)).alias("raw"))
                    .withColumn("alias", F.lit("")))
    from_refs = from_refs.unionByName(derived_refs)

    def extract(pattern: str, with_alias: bool) -> DataFrame:
        raw = F.regexp_extract_all("text", F.lit(pattern), 1)
        if not with_alias:
            return st.select("script_id", "stmt_id", F.explode(raw).alias("raw"), F.lit("").alias("alias"))
        pairs = F.arrays_zip(raw.alias("raw"), F.regexp_extract_all("text", F.lit(pattern), 2).alias("alias"))
        return (st.select("script_id", "stmt_id", F.explode(pairs).alias("p"))
                .select("script_id", "stmt_id", "p.raw", "p.alias"))

    reads = (from_refs.unionByName(extract(JOIN_REF, True)).unionByName(extract(USING_REF, True))
             .filter(F.col("raw") != "").withColumn("type", F.lit("select")).withColumn("role", F.lit("read")))
    targets = None
    for verb, pattern in TARGETS.items():
        t = extract(pattern, False).withColumn("type", F.lit(verb)).withColumn("role", F.lit("target"))
        targets = t if targets is None else targets.unionByName(t)
    outputs = extract(OUTPUT_INTO, False).withColumn("type", F.lit("insert")).withColumn("role", F.lit("target"))
    refs = (reads.unionByName(targets).unionByName(outputs)
            .filter(~F.lower(F.col("raw")).startswith("sys."))   # catalog views are not tables
            .withColumn("name", _base_name(F.col("raw"))))

    # resolve alias targets (UPDATE tpd ... FROM #TempProcessingData tpd) within the statement
    alias_map = (reads.filter(F.col("alias") != "")
                 .select("script_id", "stmt_id", F.col("alias").alias("a_alias"),
                         _base_name(F.col("raw")).alias("a_name"))
                 .dropDuplicates(["script_id", "stmt_id", "a_alias"]))
    refs = (refs.join(alias_map, (refs.script_id == alias_map.script_id) & (refs.stmt_id == alias_map.stmt_id)
                      & (F.lower(refs.name) == F.lower(alias_map.a_alias)) & (refs.role == "target"), "left")
            .select(refs.script_id, refs.stmt_id, "type", "role", "raw",
                    F.coalesce(F.col("a_name"), refs.name).alias("name"), "alias"))

    # MERGE branch verbs on the merge target
    branches = (st.select("script_id", "stmt_id",
                          F.explode(F.regexp_extract_all("text", F.lit(MERGE_BRANCH), 2)).alias("verb"))
                .join(refs.filter(F.col("type") == "merge").select("script_id", "stmt_id", "raw", "name"),
                      ["script_id", "stmt_id"], "inner")
                .select("script_id", "stmt_id", F.lower("verb").alias("type"), F.lit("branch").alias("role"),
                        "raw", "name", F.lit("").alias("alias")))
    refs = refs.unionByName(branches)

    # CTE names of the script are not tables
    ctes = (scripts.select("script_id", F.explode(F.regexp_extract_all(_clean(F.col("text")), F.lit(CTE_NAME), 1))
                           .alias("cte"))
            .select("script_id", F.lower("cte").alias("cte")).distinct())
    refs = refs.join(ctes, (refs.script_id == ctes.script_id) & (F.lower(refs.name) == ctes.cte), "left_anti")
    return refs.withColumn("class", F.when(F.col("name").startswith("#"), "temporary").otherwise("permanent"))


# ------------------------------------------------------------------ reports
def table_usage(refs: DataFrame) -> DataFrame:
    """L1-L3: distinct (script_id, type, name, class)."""
    return refs.select("script_id", "type", "name", "class").distinct()


def alias_lists(refs: DataFrame) -> DataFrame:
    """L4: aliases used per table, sorted."""
    return (refs.filter((F.col("alias") != "") & (F.col("role") == "read"))
            .groupBy("script_id", "name")
            .agg(F.array_sort(F.collect_set("alias")).alias("aliases")))


def type_counts(refs: DataFrame) -> DataFrame:
    """Distinct tables per statement type, split permanent / temporary."""
    return (table_usage(refs).groupBy("script_id", "type").pivot("class", ["permanent", "temporary"])
            .agg(F.count_distinct("name")).na.fill(0))


def most_used(refs: DataFrame) -> DataFrame:
    """Read references per table, most used first."""
    return (refs.filter(F.col("role") == "read").groupBy("script_id", "name")
            .agg(F.count(F.lit(1)).alias("reads")).orderBy(F.col("reads").desc(), "name"))


def lineage_edges(refs: DataFrame) -> DataFrame:
    """Source -> target edges of each data-changing statement."""
    tgt = refs.filter(F.col("role") == "target").select("script_id", "stmt_id", F.col("type").alias("verb"),
                                                        F.col("name").alias("target"))
    src = refs.filter(F.col("role") == "read").select("script_id", "stmt_id", F.col("name").alias("source"))
    return tgt.join(src, ["script_id", "stmt_id"], "inner").filter(F.col("source") != F.col("target")).distinct()


def statement_ranges(scripts: DataFrame, refs: DataFrame) -> DataFrame:
    """first/last line of each data-changing statement with its verb and target."""
    tgt = refs.filter(F.col("role") == "target").select("script_id", "stmt_id", F.col("type").alias("verb"),
                                                        F.col("name").alias("target")).distinct()
    st = statements(scripts).select("script_id", "stmt_id", "first_line", "last_line")
    return tgt.join(st, ["script_id", "stmt_id"], "inner")


def updated_columns(scripts: DataFrame, refs: DataFrame) -> DataFrame:
    """Columns assigned by each UPDATE statement."""
    upd = refs.filter((F.col("type") == "update") & (F.col("role") == "target")).select(
        "script_id", "stmt_id", F.col("name").alias("target"))
    st = statements(scripts).select("script_id", "stmt_id", "text")
    cols = (upd.join(st, ["script_id", "stmt_id"], "inner")
            .select("script_id", "stmt_id", "target",
                    F.explode(F.regexp_extract_all("text", F.lit(SET_COLUMN), 1)).alias("column")))
    return (cols.groupBy("script_id", "stmt_id", "target")
            .agg(F.array_distinct(F.collect_list("column")).alias("columns")))


def merge_actions(scripts: DataFrame, refs: DataFrame) -> DataFrame:
    """Per MERGE, each WHEN branch with its action, and the OUTPUT INTO table."""
    m = refs.filter((F.col("type") == "merge") & (F.col("role") == "target")).select(
        "script_id", "stmt_id", F.col("name").alias("target"))
    st = statements(scripts).select("script_id", "stmt_id", "text")
    j = m.join(st, ["script_id", "stmt_id"], "inner")
    pairs = F.arrays_zip(F.regexp_extract_all("text", F.lit(MERGE_BRANCH), 1).alias("branch"),
                         F.regexp_extract_all("text", F.lit(MERGE_BRANCH), 2).alias("action"))
    out = F.regexp_extract("text", OUTPUT_INTO, 1)
    return (j.select("script_id", "stmt_id", "target", _base_name(out).alias("output_into"),
                     F.explode(pairs).alias("p"))
            .select("script_id", "stmt_id", "target",
                    F.upper(F.regexp_replace("p.branch", r"\s+", " ")).alias("branch"),
                    F.upper("p.action").alias("action"),
                    F.when(F.col("output_into") != "", F.col("output_into")).alias("output_into")))


def complexity(refs: DataFrame) -> DataFrame:
    """Statements ranked by number of table references."""
    return (refs.filter(F.col("role") == "read").groupBy("script_id", "stmt_id")
            .agg(F.count(F.lit(1)).alias("tables")).orderBy(F.col("tables").desc(), "script_id", "stmt_id"))


def update_counts(refs: DataFrame) -> DataFrame:
    """Number of UPDATE statements per target table."""
    return (refs.filter((F.col("type") == "update") & (F.col("role") == "target"))
            .groupBy("script_id", "name").agg(F.count_distinct("stmt_id").alias("updates")))
