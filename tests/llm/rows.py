"""Awkward documents that every operator of this kind must take."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

PASSAGE = " ".join(f"word{k * k % 97}x{k}" for k in range(40))


def texts() -> list[str | None]:
    long = " ".join(f"w{k * 7919 % 5003}" for k in range(30_000))
    return [
        None, "", " ", "\n\t ", "a", "a", "A", "a b", "a  b", "a\tb", "a b", "é è ê ç ß İ K",
        "x" * 5000, "y " * 3000, long, long, long + " tail", PASSAGE, PASSAGE + ".", "start " + PASSAGE,
        PASSAGE.upper(), PASSAGE + " " + PASSAGE, "日本語のテキスト 日本語", "\U0001f600 emoji \U0001f600",
        "The cat. The dog! " * 40, "The cat. The dog! " * 40, "\x1c\x1d odd \x85 space   line",
    ]


def awkward(spark: SparkSession) -> DataFrame:
    rows = [(k, t, "en" if k % 3 else None, f"src{k % 2}", len(t or "")) for k, t in enumerate(texts())]
    return spark.createDataFrame(rows, SCHEMA)


def with_repeats(spark: SparkSession) -> DataFrame:
    """Also rows without id, fully repeated rows, one id for two texts, and columns with inner names."""
    more = [
        (None, "no id here at all, no", "en", None, 3), (None, "another one without id, none", None, "s", 3),
        (3, "\n\t ", "en", "src1", 3), (3, "\n\t ", "en", "src1", 3), (7, "a different text, same id", "en", "src1", 9),
    ]
    frame = awkward(spark).unionByName(spark.createDataFrame(more, SCHEMA))
    for name in ("id", "n", "bucket", "component", "kept", "band", "u", "v", "_norm", "seed", "shard"):
        frame = frame.selectExpr("*", f"concat('clash ', lang) as {name}")
    return frame


def none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
