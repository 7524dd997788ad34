"""Consecutive numbers in an order, without a task that sees all rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.shared import written


def numbered(rows: DataFrame, order: list[str], name: str, after: int = 0) -> DataFrame:
    """``rows`` with ``name``, numbered from ``after`` + 1 in ``order``, whose columns tell the rows apart.

    The rows are sorted by ranges and written; each range's rows are counted, and only these counts (one for
    each partition) are put in order at one place. A row's number is its place in its range and those before.
    """
    place, part = "_place", "_part"
    ranged = rows.orderBy(*order).withColumn(place, F.monotonically_increasing_id())
    own = written(ranged)
    # the place has the range's number in its upper bits, and counts within the range in the lower 33
    own = own.withColumn(part, F.shiftright(place, 33))
    counts = sorted((r[part], r["n"]) for r in own.groupBy(part).agg(F.count("*").alias("n")).collect())
    starts, total = {}, after
    for p, n in counts:
        starts[p] = total
        total += n
    if not starts:
        return own.withColumn(name, F.lit(None).cast("bigint")).drop(place, part)
    before = F.create_map(*[F.lit(x) for p, n in starts.items() for x in (p, n)])
    inner = F.col(place).bitwiseAND((1 << 33) - 1)
    return own.withColumn(name, F.element_at(before, F.col(part)) + inner + 1).drop(place, part)
