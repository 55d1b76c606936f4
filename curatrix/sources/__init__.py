"""Readers and writers of the formats that question-answer sets, documents and graphs come in.

Readers return DataFrames with one schema whatever the file's form: question, answer, id, metadata (the other fields as a map).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType
from pyspark.sql.window import Window as W

from curatrix.functions.text import preprocess, trimmed

#: Encodings that are tried, in this order.
ENCODINGS = ("UTF-8", "GBK", "GB2312", "UTF-16")


def _flat(df: DataFrame) -> DataFrame:
    """Rows of a JSON file that wraps its list in qa_pairs or data."""
    for wrap in ("qa_pairs", "data"):
        if wrap in df.columns and isinstance(df.schema[wrap].dataType, ArrayType):
            return df.select(F.explode(wrap).alias("r")).select("r.*")
    return df


def _metadata(df: DataFrame, rest: list[str]) -> Column:
    if not rest:
        return F.create_map().cast("map<string,string>")
    if rest == ["metadata"] and isinstance(df.schema["metadata"].dataType, StructType):
        return F.create_map(*[x for f in df.schema["metadata"].dataType.names for x in (F.lit(f), F.col(f"metadata.{f}").cast("string"))])
    return F.map_filter(F.create_map(*[x for c in rest for x in (F.lit(c), F.to_json(c) if isinstance(df.schema[c].dataType, (StructType, ArrayType)) else F.col(c).cast("string"))]), lambda _, v: v.isNotNull())


def qa_pairs(spark: SparkSession, path: str) -> DataFrame:
    """json, jsonl, csv, tsv, parquet or (where pandas can read it) xlsx.

    Aliases q and a are accepted; both texts are trimmed; rows that lack one are dropped; a missing id is qa_ and the row's position (from 0) in the files as they are
    read, however they are split. Empty files give an empty table.
    """
    kind = path.rsplit(".", 1)[-1].lower()
    if kind == "json":
        df = _flat(spark.read.option("multiLine", True).json(path))
    elif kind == "jsonl":
        df = spark.read.json(path)
    elif kind in ("csv", "tsv"):
        df = spark.read.option("header", True).option("sep", "," if kind == "csv" else "\t").option("multiLine", True).option("escape", '"').csv(path)
    elif kind in ("xlsx", "xls"):
        import pandas as pd

        df = spark.createDataFrame(pd.read_excel(path, dtype=str))
    else:
        df = spark.read.parquet(path)
    side = lambda names: F.coalesce(*[F.col(n).cast("string") for n in names if n in df.columns] or [F.lit(None).cast("string")])
    rest = [c for c in df.columns if c not in ("question", "answer", "q", "a", "id", "_corrupt_record")]
    given = F.col("id").cast("string") if "id" in df.columns else F.lit(None).cast("string")
    out = numbered(df.select(given.alias("id"), trimmed(side(("question", "q"))).alias("question"), trimmed(side(("answer", "a"))).alias("answer"), _metadata(df, rest).alias("metadata")))
    out = out.where("question is not null and answer is not null")
    return out.select(F.coalesce("id", F.concat(F.lit("qa_"), F.col("position"))).alias("id"), "question", "answer", "metadata")


def numbered(df: DataFrame) -> DataFrame:
    """Adds position: the number of rows before, over all parts in order. Only the counts of the parts (a row each) are summed up."""
    df = df.withColumn("_row", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_row", 33)).withColumn("_row", F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)))
    n = df.groupBy("_part").agg(F.count("*").alias("_n"))
    before = n.select("_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return df.join(F.broadcast(before), "_part").withColumn("position", F.col("_before") + F.col("_row")).drop("_part", "_row", "_before")


def documents(spark: SparkSession, path: str, text: str = "Abstract", title: str = "论文标题") -> DataFrame:
    """doc_id, text, title, fingerprint from a JSON list of documents; fails if a document lacks its id."""
    df = spark.read.option("multiLine", True).json(path) if path.endswith(".json") else spark.read.parquet(path)
    if "doc_id" not in df.columns or not df.where("doc_id is null").isEmpty():
        raise ValueError("every document needs a doc_id")
    field = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    out = df.select("doc_id", field(text).alias("text"), field(title).alias("title"))
    return out.withColumn("fingerprint", F.md5(preprocess(F.concat(F.coalesce("text", F.lit("")), F.coalesce("title", F.lit(""))))))


def texts(spark: SparkSession, path: str, pattern: str = "*.{txt,md}") -> DataFrame:
    """path, text of every file below a folder, whole."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True)
    return df.select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def any_encoding(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, text, encoding: the first encoding that reads the file without error; empty files are left out."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).where("length > 0").select("path", "content")

    @F.pandas_udf("struct<text string, encoding string>")
    def decode(c):
        import pandas as pd

        def one(b):
            for e in ENCODINGS:
                try:
                    return b.decode(e), e
                except UnicodeDecodeError:
                    pass
            return None, None

        return pd.DataFrame([one(bytes(b)) for b in c], columns=["text", "encoding"])

    return raw.select("path", decode("content").alias("x")).select("path", "x.text", "x.encoding")


def lines(spark: SparkSession, path: str, skip_empty: bool = True) -> DataFrame:
    df = spark.read.text(path).select(F.rtrim("value").alias("line"))
    return df.where(F.trim("line") != "") if skip_empty else df


def graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Node and edge tables of a saved graph; parallel edges are kept; an edge's ``type`` is its relation."""
    df = spark.read.option("multiLine", True).json(path)
    nodes, edges = df.select(F.explode("nodes").alias("n")).select("n.*"), df.select(F.explode("edges").alias("e")).select("e.*")
    if "relation" not in edges.columns and "type" in edges.columns:
        edges = edges.withColumnRenamed("type", "relation")
    return nodes, edges


def save(df: DataFrame, path: str, kind: str = "parquet", by: str | None = None) -> None:
    """parquet, json (a line per row), json_array (one array in one file), csv, orc or (where pandas can write it) xlsx, optionally parted by a column; existing data is replaced.

    One file is written by one task, row by row; a sheet is gathered on the driver and holds at most 1,048,575 rows, more are refused.
    """
    if kind == "json_array":
        row = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
        row.coalesce(1).mapInPandas(_array, "value string").write.mode("overwrite").text(path)
        return
    if kind == "xlsx":
        rows = df.limit(SHEET + 1).toPandas()
        if len(rows) > SHEET:
            raise ValueError("a sheet has no room for so many rows")
        rows.to_excel(path, index=False)
        return
    w = df.write.mode("overwrite")
    w = w.partitionBy(by) if by else w
    w = w.option("header", True) if kind == "csv" else w
    w.format(kind).save(path)


#: Rows of a sheet, its heading left out.
SHEET = 1_048_575


def _array(parts):
    """Lines of one JSON array from lines of one object each."""
    import pandas as pd

    first = True
    for p in parts:
        if len(p):
            v = ("," + p["value"]).tolist()
            if first:
                v[0] = "[" + v[0][1:]
            first = False
            yield pd.DataFrame({"value": v})
    yield pd.DataFrame({"value": ["[]" if first else "]"]})


def save_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    save(nodes, f"{path}/nodes", "json")
    save(edges, f"{path}/edges", "json")


def nested_subgraphs(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """A row per subgraph with its nodes and edges in arrays: a subgraph is one record of the format, so it has to fit one."""
    n = nodes.groupBy("subgraph_id").agg(F.array_sort(F.collect_list(F.struct("node", "type"))).alias("nodes"), F.count("*").alias("num_nodes"))
    e = edges.groupBy("subgraph_id").agg(F.array_sort(F.collect_list(F.struct("src", "dst", "relation"))).alias("edges"), F.count("*").alias("num_edges"))
    return n.join(e, "subgraph_id", "left").withColumn("num_edges", F.coalesce("num_edges", F.lit(0)))


def duplicate_details(duplicates: DataFrame, titles: DataFrame) -> DataFrame:
    """Duplicates with both titles and the similarity as a percentage."""
    a = titles.select(F.col("doc_id").alias("duplicate_id"), F.col("title").alias("duplicate_title"))
    b = titles.select(F.col("doc_id").alias("representative_id"), F.col("title").alias("representative_title"))
    return duplicates.join(a, "duplicate_id", "left").join(b, "representative_id", "left").withColumn("similarity", F.format_string("%.1f%%", F.col("similarity") * 100))


def default_ids(df: DataFrame, order: str, prefix: str = "qa_") -> DataFrame:
    """Missing ids by position in ``order`` (for small, ordered files; the window is over the file)."""
    return df.withColumn("id", F.coalesce("id", F.concat(F.lit(prefix), F.row_number().over(W.orderBy(order)) - 1)))
