"""Questions from a posts table or a CSV extract, and the question view of the fixtures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.session import spread

QUESTION_COLUMNS = [
    "Title", "Body", "Tags", "Id", "Score", "ViewCount", "FavoriteCount", "AnswerCount",
]
QUESTION_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in QUESTION_COLUMNS[:3]]
    + [T.StructField("Id", T.LongType())]
    + [T.StructField(c, T.IntegerType()) for c in QUESTION_COLUMNS[4:]]
)
MAX_QUESTIONS = 500_000
CELLS = 4096


def is_useful_question() -> Column:
    """S1's filter: viewed, liked, answered questions with at least five tags."""
    tag_count = F.length("Tags") - F.length(F.replace(F.col("Tags"), F.lit("<"), F.lit("")))
    return (
        (F.col("PostTypeId") == 1)
        & (F.col("ViewCount") > 10)
        & (F.col("FavoriteCount") > 10)
        & (F.col("Score") > 5)
        & (F.col("AnswerCount") > 0)
        & (tag_count >= 5)
    )


def cutoff_id(ids: DataFrame, limit: int) -> int | None:
    """The ``limit``-th lowest id, None when there are not as many.

    Ids are counted in ``CELLS`` equal ranges; the range that holds the wanted one is cut again until it is
    a single id. Every round is a partial aggregation to at most ``CELLS`` rows; nothing is sorted.
    """
    low, high = ids.agg(F.min("Id"), F.max("Id")).first()
    while low is not None and limit > 0:
        width = -(-(high - low + 1) // CELLS)
        cell = F.floor((F.col("Id") - low) / width).alias("cell")
        inside = ids.where((F.col("Id") >= low) & (F.col("Id") <= high))
        for r in inside.groupBy(cell).count().orderBy("cell").collect():
            if r["count"] >= limit:
                low = low + r["cell"] * width
                high = low + width - 1
                break
            limit -= r["count"]
        else:
            return None
        if width == 1:
            return low
    return None


def question_extract(posts: DataFrame, limit: int = MAX_QUESTIONS) -> DataFrame:
    """The useful questions with the lowest ``limit`` ids.

    The cut-off id is found on the id column alone; the wide rows are then only filtered,
    never sorted or gathered.
    """
    kept = posts.where(is_useful_question())
    last = cutoff_id(kept.select("Id"), limit)
    return (kept if last is None else kept.where(F.col("Id") <= last)).select(*QUESTION_COLUMNS)


# Blanks at the ends of a value belong to it; a quote inside is doubled.
_CSV = {
    "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def load_questions(spark: SparkSession, path: str) -> DataFrame:
    """CSV extract; bodies hold newlines and quotes. One file is one task, because
    quoted newlines cannot be split: convert large extracts to parquet once."""
    return spark.read.schema(QUESTION_SCHEMA).options(multiLine=True, **_CSV).csv(path)


def write_questions(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(quoteAll=True, **_CSV).csv(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _question_columns(lines: Column) -> dict[str, Column]:
    return {
        "Id": F.col("doc_id"),
        "Title": F.substr(F.get(lines, F.lit(0)), F.lit(1), F.lit(200)),
        "Body": F.col("text"),
        "Score": F.size(F.split("text", " ")),
        "ViewCount": F.col("n_chars"),
        "FavoriteCount": F.floor(F.col("n_chars") / 10),
        "AnswerCount": F.size(lines),
        "PostTypeId": F.when(F.col("doc_id") % 5 == 0, 2).otherwise(1),
    }


def document_posts(spark: SparkSession, sf_dir: str, with_tags: bool = True) -> DataFrame:
    """The ``documents`` table as posts; invented counters, tags from the labels.

    Without tags the join with ``labels`` is left out.
    """
    docs = spread(read_table(spark, sf_dir, "documents"), "doc_id")
    columns = _question_columns(F.split("text", "\n"))
    if with_tags:
        docs = docs.join(read_table(spark, sf_dir, "labels"), "doc_id", "left")
        mark = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("na"))
        columns["Tags"] = F.concat(
            F.lit("<"), "lang", F.lit("><"), "source", F.lit("><q-"), mark("quality"),
            F.lit("><t-"), mark("toxic"), F.lit("><len-"), F.length(F.col("n_chars").cast("string")), F.lit(">"),
        )
    return docs.select(*[c.alias(name) for name, c in columns.items()])


def page_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``pages`` table with its HTML as question bodies."""
    pages = spread(read_table(spark, sf_dir, "pages"), "page_id")
    return pages.select(F.col("page_id").alias("Id"), F.col("html").alias("Body"))
