"""Problem 2: frequency of every distinct value or term.

Method: per record and field, terms are counted first (partial hash aggregation in each task, then
by record and term), so that what is shuffled by term has one row per record and term, combined
again before the shuffle; occurrences and records are then summed and frequency bounds applied.

Defined cases: a term is the value's look in lower case, runs of white space one blank, outer
blanks gone; null, blank and empty terms are left out; repeated rows (same hit) count once; rows
with a null record id are left out; extra columns are ignored; an empty table gives no rows. A
term or record holding any share of all rows is combined in each task before it is shuffled.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.textfn import WS
from ..session import Scratch
from .textform import STABLE, look

RARE, COMMON = 2, 200  # rare: in at most RARE records; common: in more than one record in COMMON


@F.pandas_udf(StringType())
def _look(s: pd.Series) -> pd.Series:
    return s.map(look, na_action="ignore")


def term(value: Column) -> Column:
    """The term of a value. Only values beyond ASCII and composed Hangul go through Python."""
    odd = ~value.rlike(STABLE)
    seen = F.coalesce(_look(F.when(odd, value)), F.when(~odd, value))
    return F.trim(F.regexp_replace(F.lower(seen), f"[{WS}]+", " "))


def term_counts(df: DataFrame, fields: list[str], id_col: str = "text_id", hit_col: str = "hit_id", rare: int = RARE, common: int = COMMON) -> DataFrame:
    """(field_name, term, occurrences, records, mark), one row per distinct term of each field; mark is rare, common or null."""
    scratch = Scratch(df.sparkSession, "terms")
    rows = df.select(F.col(id_col).alias("id"), F.col(hit_col).alias("hit"), *[F.col(f).cast("string") for f in fields]).where("id is not null")
    hits = rows.dropDuplicates()
    values = hits.select("id", F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields])).alias("x")).select("id", "x.*").where("value is not null")
    terms = values.withColumn("term", term(F.col("value"))).where("term <> ''")
    per_record = scratch.keep(terms.groupBy("id", "field_name", "term").agg(F.count(F.lit(1)).alias("n")), "per_record")
    sizes = per_record.select("field_name", "id").distinct().groupBy("field_name").agg(F.count(F.lit(1)).alias("m"))
    counts = per_record.groupBy("field_name", "term").agg(F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("records"))
    mark = F.when(F.col("records") <= rare, "rare").when(F.col("records") * common > F.col("m"), "common")
    return counts.join(F.broadcast(sizes), "field_name").withColumn("mark", mark).drop("m")  # sizes: a row per field
