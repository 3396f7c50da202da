"""Problem 4: visually identical text with different characters.

Method: texts with any character beyond ASCII and composed Hangul are exploded to positioned code
points; a broadcast table (every compatibility decomposition, invisible characters, spaces, look-alike
letters: some ten thousand rows, fixed by Unicode) is joined on the code point; combining marks are
ordered by their class within a segment (a starter and the marks after it); strings are rebuilt in
that order and recomposed. A letter with marks is its own letter if it composes with them, so only
letters that stand alone take their look-alike in the join; what is left of a letter whose marks
don't compose takes it on recomposition. All other texts are in the one form already.

Composed Hangul syllables stay whole, for only a following final consonant can change them, which
recomposition joins. Defined cases: null stays null, empty and blank texts stay as they are but for
their space characters; rows are matched by id, repeated ids with one text count once; extra
columns are ignored; an empty table gives an empty table. A very long text is one group, as it is
one value in any case; rows of a text travel as one shuffled string, not as code points.
"""

from __future__ import annotations

import sys
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import Scratch
from .skew import hot_keys, sliced_join
from .textform import LOOKALIKES, STABLE

_like = str.maketrans(LOOKALIKES)
TRAILING = 999  # place of marks behind the last starter of their segment


def decompositions(spark: SparkSession) -> DataFrame:
    """(cp, parts: array of place, class, ch; alone: the same where a look-alike stands without marks) for every code
    point that is not left as it is; fixed by Unicode, about 8,000 rows."""
    rows = []
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        kind = unicodedata.category(ch)
        full = unicodedata.normalize("NFKD", ch)
        if kind == "Cf":
            full = ""
        elif kind == "Zs":
            full = " "
        single = unicodedata.normalize("NFKC", ch)
        like = single.translate(_like) if single.translate(_like) != single else None
        if full == ch and not unicodedata.combining(ch) and like is None:
            continue
        full = "".join(" " if unicodedata.category(c) == "Zs" else c for c in full if unicodedata.category(c) != "Cf")
        rows.append((cp, _placed(full), None if like is None else _placed(like)))
    kind = "array<struct<place int, class int, ch string>>"
    return spark.createDataFrame(pd.DataFrame(rows, columns=["cp", "parts", "alone"]), f"cp int, parts {kind}, alone {kind}")


def _placed(full: str) -> list[tuple[int, int, str]]:
    starters = [i for i, c in enumerate(full) if not unicodedata.combining(c)]
    last = starters[-1] if starters else -1
    return [(TRAILING if i > last else i, unicodedata.combining(c), c) for i, c in enumerate(full)]


def _mark_class() -> str:
    marks = [cp for cp in range(0x300, 0x1F000) if unicodedata.combining(chr(cp))]
    spans: list[list[int]] = []
    for cp in marks:
        if spans and spans[-1][1] == cp - 1:
            spans[-1][1] = cp
        else:
            spans.append([cp, cp])
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans)


@F.pandas_udf(StringType())
def _recompose(s: pd.Series) -> pd.Series:
    def one(x: str) -> str:
        while (made := unicodedata.normalize("NFC", x).translate(_like)) != x:  # a look-alike letter that becomes Latin can take up the mark behind it
            x = made
        return x

    return s.map(one, na_action="ignore")


def _rebuilt(df: DataFrame) -> DataFrame:
    """(id, text, look) of rows whose text may change: exploded, mapped, ordered, rebuilt."""
    marks = _mark_class()
    # One shuffle, of the strings; all that follows stays in place. The number of partitions is given, since the
    # adaptive planner would join them by the size of the strings, which the explosion multiplies.
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    rows = df.repartition(parts, "id").dropDuplicates(["id", "text"])
    segments = rows.select("id", "text", F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s)[^{marks}][{marks}]*|[{marks}]+"), F.lit(0))).alias("seg", "s"))
    points = segments.select("id", F.xxhash64("text").alias("t"), "seg", (F.char_length("s") == 1).alias("lone"), F.posexplode(F.split("s", "")).alias("pos", "ch")).where("ch <> ''")
    mapped = points.withColumn("cp", F.ascii("ch")).join(F.broadcast(decompositions(df.sparkSession)), "cp", "left")
    own = F.array(F.struct(F.lit(0).alias("place"), F.lit(0).alias("class"), F.col("ch").alias("ch")))
    parts = mapped.select("id", "t", "seg", "pos", F.posexplode(F.coalesce(F.when(F.col("lone"), F.col("alone")), F.col("parts"), own)).alias("sub", "p"))
    last = F.when((F.col("pos") > 0) | (F.col("p.place") == TRAILING), TRAILING).otherwise(F.col("p.place"))
    order = F.struct("seg", last.alias("place"), F.col("p.class").alias("class"), "pos", "sub", F.col("p.ch").alias("ch"))
    built = parts.groupBy("id", "t").agg(F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["ch"]), "").alias("built"))
    return built.select("id", "t", _recompose("built").alias("look"))


def unify(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, look), one row per distinct id and text."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    stable = F.coalesce(F.col("text").rlike(STABLE), F.lit(True))
    odd = rows.where(~stable)
    looks = odd.repartition("id").dropDuplicates(["id", "text"]).withColumn("t", F.xxhash64("text")).join(_rebuilt(odd), ["id", "t"], "left")
    # Only invisible characters: nothing was left to rebuild.
    return rows.where(stable).distinct().withColumn("look", F.col("text")).unionByName(looks.select("id", "text", F.coalesce("look", F.lit("")).alias("look")))


def _records(df: DataFrame, id_col: str, text_col: str, scratch: Scratch) -> DataFrame:
    """(id, t, l1, l2, changed) of every record with a letter or digit: hashes of its text and of its look."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null")
    stable = F.col("text").rlike(STABLE)
    key = lambda c: [F.xxhash64(c).alias("l1"), F.xxhash64(F.lit(1), c).alias("l2")]
    worded = lambda c: F.col(c).rlike(r"[\p{L}\p{N}]")
    clean = rows.where(stable & worded("text")).select("id", F.xxhash64("text").alias("t"), *key("text"), F.lit(False).alias("changed"))
    odd = _rebuilt(rows.where(~stable)).where(worded("look")).select("id", "t", *key("look"))
    return scratch.keep(clean.unionByName(odd.withColumn("changed", F.col("t") != F.col("l1"))), "records")


def lookalike_classes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, class_id, links): every record that looks like another of different code points, the smallest id of its look, and
    the number of records it looks like. One row per record (and text of it), however many look alike."""
    scratch = Scratch(df.sparkSession, "unify")
    records = _records(df, id_col, text_col, scratch)
    variants = scratch.keep(records.groupBy("l1", "l2", "t").agg(F.countDistinct("id").alias("n"), F.min("id").alias("least")), "variants")
    looks = variants.groupBy("l1", "l2").agg(F.sum("n").alias("all"), F.min("least").alias("class_id"), F.count(F.lit(1)).alias("k")).where("k > 1")
    hot = hot_keys(records, ["l1", "l2"], records.count())
    linked = sliced_join(variants, looks, ["l1", "l2"], hot, "t").select("l1", "l2", "t", "class_id", (F.col("all") - F.col("n")).alias("links"))
    return sliced_join(records.select("id", "l1", "l2", "t").distinct(), linked.drop("l1", "l2"), ["t"], hot_keys(records, ["t"], records.count()), "id").select("id", "class_id", "links")


def lookalike_pairs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key_a, key_b): records with equal looks, a letter or digit in them, and different code points; key_a < key_b.

    Of two such records at least one is not its own look, so a clean record only takes part if a changed one has
    its look. Variants (distinct texts of one look) are paired, then members joined to them, hot ones in slices.
    """
    scratch = Scratch(df.sparkSession, "unify")
    records = _records(df, id_col, text_col, scratch)
    variants = scratch.keep(records.groupBy("l1", "l2", "t").agg(F.max("changed").alias("changed")), "variants")
    a, b = variants.where("changed").select("l1", "l2", F.col("t").alias("ta")), variants.select("l1", "l2", F.col("t").alias("tb"), F.col("changed").alias("both"))
    pairs = scratch.keep(a.join(b, ["l1", "l2"]).where("ta <> tb and (not both or ta < tb)").select("l1", "ta", "tb"), "pairs")
    hot = hot_keys(records, ["t"], records.count())
    members = records.select("id", "t", "l1").distinct()
    of = lambda k, t: members.select(F.col("id").alias(k), F.col("t").alias(t), "l1")
    one = sliced_join(of("x", "ta"), pairs, ["ta", "l1"], hot.join(members, "t").select(F.col("t").alias("ta"), "l1"), "x")
    two = sliced_join(of("y", "tb"), one, ["tb", "l1"], hot.join(members, "t").select(F.col("t").alias("tb"), "l1"), "y")
    return two.where("x <> y").select(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b")).distinct()
