"""JDBC sink for stored catalog rows, and the tolerant write around it.

The original loader opened one connection per partition, inserted row by
row and swallowed every failing insert. Here the failures a database would
raise are found up front with DataFrame operations (decode errors, NULL
keys, duplicate keys within the batch, keys already stored), rejected rows
are kept with a reason, and only clean rows are appended -- in batches,
with a capped number of connections.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.decode import append_constants, decode_lines
from lodestar.schema import STORED_SCHEMA
from lodestar.sinks.frames import materialise

STORED_COLUMNS = tuple(f.name for f in STORED_SCHEMA.fields)


def jdbc_frame(stored: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The 17 stored columns in table order (plus ``extra`` pass-through columns)."""
    return stored.select(*STORED_COLUMNS, *extra)


def jdbc_append(stored: DataFrame, url: str, table: str, *, user: str | None = None,
                password: str | None = None, driver: str | None = None,
                batchsize: int = 1000, max_connections: int | None = None,
                extra_options: dict[str, str] | None = None) -> dict:
    """Append stored rows to ``table``; returns ``{"written": n}``.

    ``max_connections`` caps concurrent connections (Spark coalesces to that
    many write tasks); each task inserts in batches of ``batchsize``. The
    count is observed in the same pass as the write.

    Executor loss: Spark commits each write task's rows in one transaction
    (on databases with transactions), so a task lost mid-way rolls back and
    its retry writes the partition again. A task lost after its commit but
    before reporting back is replayed too; give the table a primary key
    (and flag with ``key=``) so such a replay is refused, not duplicated.
    """
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if max_connections is not None:
        opts["numPartitions"] = str(max_connections)
    opts.update(extra_options or {})
    obs = Observation("jdbc_append")
    counted = jdbc_frame(stored).observe(obs, F.count(F.lit(1)).alias("written"))
    counted.write.format("jdbc").options(**opts).mode("append").save()
    return dict(obs.get)


@dataclass
class TolerantResult:
    flagged: DataFrame    # every line: keep columns, stored columns, line, reason (NULL = accepted)
    accepted: DataFrame   # stored rows (keep columns + 17 columns)
    rejected: DataFrame   # keep columns, line, reason


def tolerant_write(lines: DataFrame, text_col: str = "value", key: Sequence[str] = (),
                   keep: Sequence[str] = (), existing_keys: DataFrame | None = None,
                   on_error: str = "quarantine") -> TolerantResult:
    """Flag every catalog line as storable or rejected with a reason.

    Reasons, first match wins: ``arity`` / ``type:<field>`` (decode; not with
    ``on_error="keep"``, where failed records flow on with defaults),
    ``null key``, ``duplicate key`` (all but one record per key; the kept one
    has the least raw line, identical lines count as duplicates too), ``key
    exists`` (found in ``existing_keys``).

    The lines are decoded once, into a staged table that numbers them.
    """
    ann = decode_lines(lines, text_col=text_col, keep=keep)
    return flag_rows(ann, key, keep, existing_keys, on_error)


def flag_rows(ann: DataFrame, key: Sequence[str] = (), keep: Sequence[str] = (),
              existing_keys: DataFrame | None = None, on_error: str = "quarantine") -> TolerantResult:
    """:func:`tolerant_write` over an annotated decode (``decode_lines`` output).

    Only records that can be stored take part in the key check; failed lines
    and NULL keys, however many, never meet in one task. One survivor per key
    is a partial aggregate; the survivors are staged with whether their key is
    already stored, and joined back once. Both sides of that join are read
    from staged tables, so a key that a third of the lines share is a skewed
    equi-join that the adaptive planner splits.
    """
    if on_error not in ("quarantine", "keep"):
        raise ValueError(f"unknown error mode {on_error!r}; use quarantine or keep")
    keep, key = tuple(keep), tuple(key)
    failed = F.col("error").isNotNull() if on_error == "quarantine" else F.lit(False)
    reason = F.when(failed, F.concat_ws(":", "error", "error_field"))
    if key:
        ann = materialise(ann.withColumn("_rid", F.monotonically_increasing_id()), how="parquet",
                          name="catalog-numbered")
        null_key = F.lit(False)
        for k in key:
            null_key = null_key | F.col(k).isNull()
        cand = ann.filter(~failed & ~null_key)
        # the decoded fields are a function of the raw line, so the line (then
        # the keep columns, then the number) orders records fully
        rec = F.struct(F.col("_text"), *[F.col(c) for c in keep], F.col("_rid"))
        winners = cand.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(key)]).agg(F.min(rec)["_rid"].alias("_win"))
        exists = F.lit(False)
        if existing_keys is not None:
            stored = existing_keys.select(*[F.col(k).alias(f"_old{i}") for i, k in enumerate(key)]).distinct()
            winners = winners.join(stored, [F.col(f"_key{i}") == F.col(f"_old{i}") for i in range(len(key))], "left")
            exists = F.col("_old0").isNotNull()
        winners = materialise(winners.withColumn("_exists", exists), how="parquet", name="catalog-keys")
        checked = cand.join(winners, [F.col(k) == F.col(f"_key{i}") for i, k in enumerate(key)])
        checked = checked.withColumn("reason", F.when(F.col("_rid") != F.col("_win"), F.lit("duplicate key"))
                                     .when(F.col("_exists"), F.lit("key exists")))
        others = ann.filter(failed | null_key).withColumn("reason", reason.otherwise(F.lit("null key")))
        ann = checked.select(*others.columns).unionByName(others)
    else:
        ann = ann.withColumn("reason", reason)
    flagged = append_constants(ann).select(*keep, *STORED_COLUMNS, F.col("_text").alias("line"), "reason")
    accepted = flagged.filter(F.col("reason").isNull()).select(*keep, *STORED_COLUMNS)
    rejected = flagged.filter(F.col("reason").isNotNull()).select(*keep, "line", "reason")
    return TolerantResult(flagged=flagged, accepted=accepted, rejected=rejected)


def write_catalog(lines: DataFrame, url: str, table: str, rejects_path: str, *,
                  text_col: str = "value", key: Sequence[str] = (),
                  existing_keys: DataFrame | None = None, on_error: str = "quarantine",
                  load_id: str | None = None, **jdbc_options) -> dict:
    """Catalog load into a database.

    Decode and flag duplicates and existing keys, stage the flagged rows, keep
    the rejects as Parquet, then append the accepted rows over JDBC. Staging
    makes each step restartable after a lost executor. The rejects go to
    ``<rejects_path>/load=<load_id>``, which a repeated load with the same id
    overwrites. Returns the counts and the id."""
    load_id = load_id or uuid.uuid4().hex
    res = tolerant_write(lines, text_col=text_col, key=key, existing_keys=existing_keys, on_error=on_error)
    staged = materialise(res.flagged, how="parquet", name="catalog-staged")
    (staged.filter(F.col("reason").isNotNull()).select("line", "reason")
     .write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/load={load_id}"))
    written = jdbc_append(staged.filter(F.col("reason").isNull()), url, table, **jdbc_options)
    counts = staged.agg(F.count(F.lit(1)).alias("attempted"),
                        F.count("reason").alias("rejected")).first()
    return {"load_id": load_id, "attempted": counts["attempted"], "rejected": counts["rejected"], **written}


def stored_keys(spark: SparkSession, url: str, table: str, key: Sequence[str], *, user: str | None = None,
                password: str | None = None, driver: str | None = None) -> DataFrame:
    """The key columns already in ``table``, read over JDBC (for ``existing_keys``)."""
    opts = {k: v for k, v in (("user", user), ("password", password), ("driver", driver)) if v is not None}
    return spark.read.format("jdbc").options(url=url, dbtable=table, **opts).load().select(*key)
