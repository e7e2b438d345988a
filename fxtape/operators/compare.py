"""Comparison and reconciliation of two relations, by key and field."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fxtape.functions.contract import COORDINATE, EVENT_FIELDS
from fxtape.functions.scalars import differs
from fxtape.shared import published


def _differing(fields: Sequence[str], left: str, right: str) -> Column:
    """Names of the fields on which two structs differ, NULLs being equal."""
    names = [
        F.when(differs(F.col(f"{left}.{name}"), F.col(f"{right}.{name}")), F.lit(name))
        for name in fields
    ]
    return F.array_compact(F.array(*names))


def _per_key(df: DataFrame, keys: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """One row per key: a row's fields, and how often the key occurs.

    Copies of a key shrink in the partial aggregation, so the join that follows meets each key
    once per side and never pairs up repeated rows.
    """
    return df.groupBy(*keys).agg(
        F.max(F.struct(*fields)).alias(name), F.count(F.lit(1)).alias(f"{name}_rows")
    )


def compare_rows(
    left: DataFrame, right: DataFrame, keys: Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """Full outer comparison of two relations that should be unique by ``keys``.

    One row per key with ``problems``: ``missing`` (only left), ``extra`` (only right),
    ``repeated``, or the names of the differing fields; empty when both agree.
    """
    a, b = _per_key(left, keys, fields, "_left"), _per_key(right, keys, fields, "_right")
    problems = (
        F.when(F.col("_right_rows").isNull(), F.array(F.lit("missing")))
        .when(F.col("_left_rows").isNull(), F.array(F.lit("extra")))
        .when(F.col("_left_rows") + F.col("_right_rows") > 2, F.array(F.lit("repeated")))
        .otherwise(_differing(fields, "_left", "_right"))
    )
    return a.join(b, list(keys), "full").select(*keys, problems.alias("problems"))


def comparison_summary(compared: DataFrame) -> DataFrame:
    """One row: keys, missing, extra, differing, and the status."""
    problems = F.col("problems")
    missing = F.array_contains(problems, "missing")
    extra = F.array_contains(problems, "extra")
    counted = compared.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(missing).alias("missing"),
        F.count_if(extra).alias("extra"),
        F.count_if((F.size(problems) > 0) & ~missing & ~extra).alias("different"),
    )
    fine = (F.col("keys") > 0) & (F.col("missing") + F.col("extra") + F.col("different") == 0)
    return counted.withColumn("status", F.when(fine, "passed").otherwise("failed"))


def compare_ids(a: DataFrame, b: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Id sets and field values of two relations, as one row."""
    return comparison_summary(compare_rows(a, b, [key], fields))


def readback(sent: DataFrame, stored: DataFrame, run_id: str) -> DataFrame:
    """What a run sent against what its sink shows, as one row."""
    shown = stored.where(F.col("demo_run_id") == run_id)
    return comparison_summary(compare_rows(sent, shown, ["event_id"], EVENT_FIELDS))


@dataclass(frozen=True)
class Reconciliation:
    """``detail`` lists coordinate and problem, ``summary`` is one row with the status."""

    detail: DataFrame
    summary: DataFrame


def _by_coordinate(events: DataFrame, counts: Mapping[str, Column]) -> DataFrame:
    return events.groupBy(*COORDINATE).agg(*[value.alias(n) for n, value in counts.items()])


RANGE_BITS = 6  # 64 offsets to a range, as many as a long has bits
RANGE_KEY = ["kafka_topic", "kafka_partition", "_range"]


def in_ranges(events: DataFrame) -> DataFrame:
    """Events with the range of offsets they belong to."""
    return events.withColumn("_range", F.shiftright(F.col("kafka_offset").cast("long"), RANGE_BITS))


def event_hashes() -> list[Column]:
    """Two 64-bit hashes of an event and its coordinate. The hash function passes over a NULL, so
    which fields are NULL is hashed as well."""
    fields = [*COORDINATE, *EVENT_FIELDS]
    absent = F.concat(*[F.when(F.col(name).isNull(), "1").otherwise("0") for name in fields])
    return [F.xxhash64(F.lit(seed), absent, *fields) for seed in (1, 2)]


def range_digests(events: DataFrame, prefix: str, *more: Column) -> DataFrame:
    """One row per range of offsets: its number of rows and a digest of its events as a multiset.

    The digest adds up both hashes by halves, so it depends on no order, is summed before
    the shuffle, and counts a repeated row as often as it occurs.
    """
    halves = {}
    for number, value in enumerate(("_first", "_second")):
        halves[f"{prefix}{2 * number}"] = F.sum(F.col(value).bitwiseAND(F.lit(0xFFFFFFFF)))
        halves[f"{prefix}{2 * number + 1}"] = F.sum(F.shiftrightunsigned(value, 32))
    first, second = event_hashes()
    hashed = in_ranges(events).withColumns({"_first": first, "_second": second})
    return hashed.groupBy(*RANGE_KEY).agg(
        F.count(F.lit(1)).alias(f"{prefix}rows"), *[v.alias(n) for n, v in halves.items()], *more
    )


def compared_ranges(captured: DataFrame, stored: DataFrame) -> DataFrame:
    """The ranges with captured events, and whether each is ``equal``.

    A range is equal when its captured events are valid, no offset occurs twice, and the stored events
    are the same ones: their numbers and digests of 128 bits agree. Both sides are shuffled once, with
    a row per range.
    """
    place = F.pmod("kafka_offset", F.lit(1 << RANGE_BITS)).cast("int")
    offsets = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    expected = range_digests(
        captured, "a", F.count("error").alias("invalid"), F.bit_count(offsets).alias("offsets"),
        F.count("kafka_offset").alias("known"),
    )
    both = expected.join(range_digests(stored, "b"), RANGE_KEY, "left")
    equal = (F.col("invalid") == 0) & (F.col("offsets") == F.col("arows")) & (F.col("known") == F.col("arows"))
    for name in ("rows", "0", "1", "2", "3"):
        equal = equal & F.col(f"b{name}").eqNullSafe(F.col(f"a{name}"))
    return both.select(*RANGE_KEY, F.col("arows").alias("rows"), equal.alias("equal"))


def reconcile_events(captured: DataFrame, stored: DataFrame) -> Reconciliation:
    """Captured events (decoded, with ``error``) against stored events, by coordinate.

    Fails when nothing was captured, when a captured record is invalid or contradicts another
    one of the same coordinate, when a coordinate is not stored, or when a stored field differs.
    Stored rows with foreign coordinates are ignored, duplicates are counted.

    Ranges of offsets are compared by digests first; only events of ranges that differ are compared
    field by field. Copies of a row are counted before the join, in the partial aggregation already, so
    many copies of one coordinate reach the join as one row.

    Coordinates that are NULL match nothing stored and are missing.
    """
    ranges = published(compared_ranges(captured, stored), "ranges")
    unequal = ranges.where(~F.col("equal")).select(*RANGE_KEY)
    same = [F.col(f"_l.{name}").eqNullSafe(F.col(f"_r.{name}")) for name in RANGE_KEY]

    def of_unequal(events: DataFrame) -> DataFrame:
        return in_ranges(events).alias("_l").join(unequal.alias("_r"), same, "left_semi").drop("_range")

    matched = _matched(of_unequal(captured), of_unequal(stored))
    detail = matched.select(
        *COORDINATE, F.explode("problems").alias("problem"), F.coalesce("copies", F.lit(0)).alias("rows")
    )
    per_coordinate = _by_coordinate(
        matched,
        {
            "raw_copies": F.max("raw_copies"),
            "copies": F.sum("copies"),
            "event_id": F.max("event.event_id"),
            "missing": F.max(F.array_contains("problems", "missing").cast("int")),
            "refused": F.max(
                (F.array_contains("problems", "invalid") | F.array_contains("problems", "conflict"))
                .cast("int")
            ),
            "mismatches": F.sum(
                F.when(F.col("copies").isNotNull(), F.size("problems") * F.col("copies")).otherwise(0)
            ),
        },
    )
    # What is equal is counted on the stored side, which needs no decoding.
    agreed = in_ranges(stored).join(ranges.where("equal").select(*RANGE_KEY), RANGE_KEY, "left_semi").select(
        F.lit(1).cast("long").alias("raw_copies"), F.lit(1).cast("long").alias("copies"), "event_id",
        *[F.lit(0).alias(name) for name in ("missing", "refused", "mismatches")],
    )
    counted = per_coordinate.drop(*COORDINATE).unionByName(agreed)
    # Ids are grouped once; the other numbers are summed on the way.
    per_id = counted.groupBy("event_id").agg(
        F.sum("raw_copies").alias("raw_copies"), F.count(F.lit(1)).alias("coordinates"),
        F.count("copies").alias("found"), F.sum("missing").alias("missing"), F.sum("refused").alias("refused"),
        F.sum("mismatches").alias("mismatches"), F.sum(F.col("copies") - 1).alias("surplus"),
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    summary = per_id.agg(
        total("raw_copies").alias("raw_records"),
        total("coordinates").alias("raw_coordinates"),
        total("found").alias("warehouse_coordinates"),
        total("missing").alias("missing"),
        total("refused").alias("refused"),
        total("mismatches").alias("mismatches"),
        total("surplus").alias("duplicate_warehouse_rows"),
        F.count("event_id").alias("unique_event_ids"),
    )
    clean = F.col("missing") + F.col("refused") + F.col("mismatches") == 0
    passed = (F.col("raw_coordinates") > 0) & clean
    return Reconciliation(
        detail, summary.withColumn("status", F.when(passed, "passed").otherwise("failed"))
    )


def _matched(captured: DataFrame, stored: DataFrame) -> DataFrame:
    """Captured events beside each version that is stored at their coordinate, with the problems."""
    event = F.struct(*EVENT_FIELDS)
    hashes = F.struct(*event_hashes())
    expected = _by_coordinate(
        captured.select(*COORDINATE, event.alias("event"), "error", hashes.alias("digest")),
        {
            "raw_copies": F.count(F.lit(1)),
            "invalid": F.count("error"),
            "conflict": F.min("digest") != F.max("digest"),
            "event": F.max_by("event", "digest"),
        },
    )
    found = (
        stored.groupBy(*COORDINATE, *EVENT_FIELDS)
        .agg(F.count(F.lit(1)).alias("copies"))
        .select(*COORDINATE, event.alias("stored"), "copies")
    )
    problems = (
        F.when(F.col("invalid") > 0, F.array(F.lit("invalid")))
        .when(F.col("conflict"), F.array(F.lit("conflict")))
        .when(F.col("copies").isNull(), F.array(F.lit("missing")))
        .otherwise(_differing(EVENT_FIELDS, "event", "stored"))
    )
    return expected.join(found, COORDINATE, "left").withColumn("problems", problems)


def publication_gate(
    captured: DataFrame, valid: DataFrame, report: DataFrame, stored: DataFrame | None = None
) -> DataFrame:
    """One row: whether a run may be published.

    ``report`` is the run's one row of counters. Capture and output must reconcile and have the
    reported sizes, the run must have passed in replay mode only, and once ``stored`` is given it
    must reconcile too and hold as many rows as the output.
    """
    summary = reconcile_events(captured, valid).summary.select(
        "raw_records", "status", F.lit(1).alias("_one")
    )
    sizes = valid.agg(F.count(F.lit(1)).alias("valid_rows")).withColumn("_one", F.lit(1))
    told = report.select(
        F.col("kafka_records").alias("reported_records"),
        F.col("valid").alias("reported_valid"),
        F.col("status").alias("run_status"),
        F.col("modes").alias("run_modes"),
        F.lit(1).alias("_one"),
    )
    gate = summary.join(sizes, "_one").join(told, "_one")
    replay_only = F.col("run_modes") == F.array(F.lit("replay"))
    accepted = (
        (F.col("status") == "passed")
        & (F.col("run_status") == "passed")
        & replay_only
        & (F.col("raw_records") == F.col("reported_records"))
        & (F.col("valid_rows") == F.col("reported_valid"))
    )
    if stored is not None:
        after = reconcile_events(captured, stored).summary.select(
            F.col("status").alias("stored_status"), F.lit(1).alias("_one")
        )
        rows = stored.agg(F.count(F.lit(1)).alias("stored_rows")).withColumn("_one", F.lit(1))
        gate = gate.join(after, "_one").join(rows, "_one")
        accepted = accepted & (F.col("stored_status") == "passed")
        accepted = accepted & (F.col("stored_rows") == F.col("valid_rows"))
    return gate.withColumn("accepted", F.coalesce(accepted, F.lit(False))).drop("_one")
