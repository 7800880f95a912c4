"""Problem 4: no contributor keeps more than a fixed share of the rows.

Method: radix selection. Score and id become 16 order-preserving bytes. For the contributors above
the limit, rows are counted by contributor and byte, one digit at a time, until the cutoff key is
fixed; a comparison with that key then tells the rows to remove. No contributor's rows are ever
sorted or brought into one task. A contributor over a share s of the rows is one of at most 1/s, so
the state that the driver holds is at most 256/s counts a round.

Defined cases: null, blank or unknown contributors are never capped; a null or NaN score ranks
lowest; equal scores keep the smaller id; rows repeated with the same id, contributor and score
count once; rows without an id count in the total but can be neither kept nor removed; an empty
table gives no rows. Columns other than the three named are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from vellumix.storage import written

#: Fixed value: how the data spell an unknown contributor, by letters and digits.
UNKNOWN = "unknownanonymous"
KEY_BYTES = 16


def contributor_key(author: Column) -> Column:
    """Letters and digits in lower case; null for unknown contributors."""
    key = F.regexp_replace(F.lower(author), r"[^\p{L}\p{N}]", "")
    return F.when((key != "") & (key != UNKNOWN), key)


@F.pandas_udf(BinaryType())
def rank_key(score: pd.Series, ident: pd.Series) -> pd.Series:
    """16 bytes that compare as (score ascending, id descending): the larger the better."""
    x = score.astype("float64").to_numpy(copy=True) + 0.0  # -0.0 becomes 0.0
    bits = x.view(np.int64)
    top = np.where(bits < 0, ~bits, bits ^ np.int64(-(2**63))).view(np.uint64).copy()
    top[np.isnan(x)] = 0
    low = ~(ident.to_numpy(dtype=np.int64).view(np.uint64) ^ np.uint64(1 << 63))
    raw = np.stack([top, low], axis=1).astype(">u8").tobytes()
    return pd.Series([raw[i : i + KEY_BYTES] for i in range(0, len(raw), KEY_BYTES)])


def _over_limit(df: DataFrame, id_col: str, by: str, score: str, share: float, least: int):
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), contributor_key(F.col(by)).alias("who"), F.col(score).cast("double").alias("score"))
    counts = rows.groupBy("who").agg(F.count(F.lit(1)).alias("n"), F.count("id").alias("named"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    cap = max(least, int(np.floor(share * total + 1e-9)))
    over = counts.filter(F.col("who").isNotNull() & (F.col("named") > cap)).select("who")
    return rows, over, cap


def capped_rows(df: DataFrame, id_col: str = "id", by: str = "author", score: str = "quality_total", share: float = 0.02, least: int = 3) -> DataFrame:
    """(who, id, keep) for every row of the contributors above ``max(least, floor(share * rows))``."""
    spark = df.sparkSession
    rows, over, cap = _over_limit(df, id_col, by, score, share, least)
    names = [r.who for r in over.collect()]  # at most 1 / share
    held = rows.filter(F.col("id").isNotNull() & F.col("who").isin(names)) if names else rows.limit(0)
    held = written(held.distinct().select("who", "id", rank_key("score", "id").alias("key")), "cap")
    need, prefix, cutoff = dict.fromkeys(names, cap), dict.fromkeys(names, b""), {}
    for digit in range(KEY_BYTES):
        if not prefix:
            break
        state = spark.createDataFrame(list(prefix.items()), "who string, prefix binary")
        seen = (
            held.join(F.broadcast(state), "who")
            .filter(F.expr("startswith(key, prefix)"))
            .groupBy("who", F.expr(f"substring(key, {digit + 1}, 1)").alias("byte"))
            .count()
        )
        found: dict[str, list] = {}
        for r in seen.collect():  # at most 256 / share
            found.setdefault(r.who, []).append((bytes(r.byte), r["count"]))
        for who, buckets in found.items():
            for byte, n in sorted(buckets, reverse=True):
                if n < need[who]:
                    need[who] -= n
                    continue
                if n == need[who] or digit == KEY_BYTES - 1:
                    cutoff[who] = prefix.pop(who) + byte
                else:
                    prefix[who] += byte
                break
            else:  # repeated rows made the contributor seem larger: all are kept
                cutoff[who] = b""
                prefix.pop(who)
    limits = spark.createDataFrame(list(cutoff.items()), "who string, cutoff binary")
    return held.join(F.broadcast(limits), "who").select("who", "id", (F.col("key") >= F.col("cutoff")).alias("keep"))


def removed_rows(df: DataFrame, **options) -> DataFrame:
    """Ids to remove so that no contributor exceeds the limit."""
    return capped_rows(df, **options).filter(~F.col("keep")).select("id")


def contributor_report(df: DataFrame, **options) -> DataFrame:
    """Rows kept and removed of each contributor above the limit."""
    keep = F.col("keep")
    return capped_rows(df, **options).groupBy(F.col("who").alias("contributor")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(keep).alias("n_kept"), F.count_if(~keep).alias("n_removed"))
