"""Record parsers: lines of a log to one typed DataFrame for each output, in native expressions.

A record is skipped where its parts can't be told, and its whole file fails where they can but are too few
or too many. ``Parsed`` holds the outputs without the rows of failed files, and the failed files.
"""

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.functions import clean
from lodestrata.schemas import LEAVES, conform
from lodestrata.shared import fenced, written
from lodestrata.sources import lines as text


class Outputs(Mapping):
    """Outputs by artifact key, each planned when it is asked for: the driver takes seconds to plan all nine of one parser."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]) -> None:
        self._makers = makers

    def __getitem__(self, key: str) -> DataFrame:
        return self._makers[key]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


@dataclass
class Parsed:
    outputs: Mapping[str, DataFrame]
    failed: DataFrame  # content_hash, message


@dataclass
class Record:
    """How a record type is read: its fields, whether it can be, and whether they are as many as there must be.

    Of a line there are ``raw`` (what stands between commas), ``t`` (the same, stripped), ``some`` (of raw what
    isn't empty), ``nav`` (the same of a navigation record), ``words`` (the bits of the words of the pressure system) and
    ``p1`` to ``p3`` (places, from 1, of the marks of a pressure record, 0 where there is none). A field is an expression
    of its own, so only those asked for are worked out.
    """

    values: Callable[[], list[Column]]
    wide: Callable[[], Column]
    readable: Callable[[], Column] = lambda: F.lit(True)
    ready: bool = False  # whether all fields but the first are of their columns' types already


def _at(tokens: Column | str, k: int) -> Column:
    return F.get(tokens, F.lit(k))


def _pick(tokens: str, places: list[int]) -> list[Column]:
    return [_at(tokens, k) for k in places]


def _nav() -> list[Column]:
    # the first two signs of a line don't count, so its tokens are those of what follows
    return [*_pick("nav", list(range(15))), *[F.substring(_at("nav", 15), k, 1) for k in range(1, 17)], *_pick("nav", [16, 17])]


def _mark(name: str, before: Column) -> Column:
    """The place of a mark behind another place; 0 if there is none, or not the other."""
    found = F.array_position(F.slice("t", (before + 1).cast("int"), F.lit(1 << 20)), name)
    return F.when((before > 0) & (found > 0), before + found).otherwise(0)


def _rpcs_pres() -> list[Column]:
    def block(start: str, end: str | None) -> list[Column]:
        """Up to ten fields behind a mark, none of them from the next one on."""
        first = F.col(start).cast("int")
        own = [F.get("t", first + k) for k in range(10)]
        return [clean.pressure(x if end is None else F.when(first + k + 1 < F.col(end), x)) for k, x in enumerate(own)]

    return [_at("t", 3), clean.carry_date(_at("t", 3), _at("t", 4)), *block("p1", "p2"), *block("p2", "p3"), *block("p3", None)]


def _pfc() -> list[Column]:
    swapped = _at("t", 3) == ""
    return [F.when(swapped, _at("t", a)).otherwise(_at("t", b)) for a, b in zip([6, 4, 5, 7, 8], [3, 4, 5, 6, 8])]


def _rfc() -> list[Column]:
    own = [_at("t", k) for k in (3, 4, 5, 6, 7, 8, *range(10, 19, 2), 19, 20, 21)]
    own[4] = F.concat(F.substring_index(own[0], " ", 1), F.lit(" "), own[4])
    return own


def _name(k: int) -> Column:
    """The name of one of the seven words of the pressure system."""
    return _at("raw", 4 + 2 * k)


def _rpcs() -> list[Column]:
    return [_at("raw", 3), *[clean.word_value(_name(k), _at("words", k)) for k in range(7)]]


def _words() -> Column:
    out = F.lit(True)
    for k in range(7):
        out &= F.coalesce(_name(k).isin(list(clean.WORDS)) & _at("words", k).isNotNull(), F.lit(False))
    return out


def _lcs() -> list[Column]:
    stamp = F.when(_at("t", 3).contains(" "), clean.carry_date(_at("t", 3), _at("t", 6))).otherwise(_at("t", 6))
    return [_at("t", 3), _at("t", 4), _at("t", 5), stamp]


def _discretes() -> list[Column]:
    return _pick("raw", [3, *range(5, 7), *range(8, 14), *range(15, 19), *range(20, 24), *range(25, 33)])


RECORDS: dict[str, tuple[str, Record]] = {
    "NAV_DATA:": ("NavData", Record(_nav, lambda: F.size("nav") == 18, lambda: F.length(_at("nav", 15)) == 16)),
    "RPCS:": ("Rpcs", Record(_rpcs, lambda: F.lit(True), _words, ready=True)),
    "RPCS_PRES:": ("RpcsPres", Record(_rpcs_pres, lambda: F.col("p3") > 0)),
    "RDR_STATE:": ("RadarState", Record(lambda: _pick("some", list(range(2, 25, 2))), lambda: F.lit(True), lambda: F.size("some") == 25)),
    "ROTOSCAN:": ("RotoScan", Record(lambda: [clean.strip(x) for x in _pick("some", list(range(2, 7)))], lambda: F.size("some") == 7)),
    "PFC_DB:": ("PfcDb", Record(_pfc, lambda: F.size("t") >= 9)),
    "RFC_DB:": ("RfcDb", Record(_rfc, lambda: F.size("t") >= 22)),
    "LCS_TEMP:": ("LcsTemp", Record(_lcs, lambda: F.size("t") >= 7)),
    "MC_IN_DISCR:": ("McInDiscr", Record(_discretes, lambda: F.size("raw") >= 33, lambda: F.size("raw") >= 4)),
}


def kind(line: Column) -> Column:
    """The record type of a line: what stands between its first two commas, with the colon."""
    return F.when(line.contains(","), F.substring_index(F.substring_index(line, ",", 2), ",", -1))


def _by_kind(of: Callable[[str, Record], Column], kinds: list[str] | None = None) -> Column:
    out = None
    for name in kinds or list(RECORDS):
        made = of(name, RECORDS[name][1])
        out = F.when(F.col("kind") == name, made) if out is None else out.when(F.col("kind") == name, made)
    return out


def _any(tests: Iterator[Column]) -> Column:
    return reduce(Column.__or__, tests)


def _cut(lines: DataFrame, kinds: list[str]) -> DataFrame:
    """The lines of some kinds with their parts, of which a kind has those that it is read by.

    Each step is a projection of its own, so what several fields need is worked out once.
    """

    def only(parts: Column, *names: str) -> Column:
        own = [k for k in kinds if k in names]
        return parts if own == kinds else F.when(F.col("kind").isin(own), parts) if own else F.lit(None).cast("array<string>")

    some = lambda x: F.array_remove(F.array_remove(x, ""), "\n")
    line, whole, signs = F.col("line"), F.col("whole"), list(clean.BLANKS)
    own = lines.withColumn("kind", kind(line)).filter(F.col("kind").isin(kinds))
    # blanks at the ends, or beside a comma, are looked for by signs: to strip or to match is many times slower
    ends = _any(line.startswith(x) | line.endswith(x) for x in signs)
    own = own.withColumn("whole", F.when(ends, clean.strip(line)).otherwise(line))
    beside = _any(whole.contains(f"{x},") | whole.contains(f",{x}") for x in " \t") | _any(whole.contains(x) for x in signs[2:])
    t = F.when(beside, F.transform(F.split("whole", ","), clean.strip)).otherwise(F.split("whole", ","))
    raw, few = only(F.split("line", ","), "RPCS:", "MC_IN_DISCR:"), only(some(F.split("line", ",")), "RDR_STATE:", "ROTOSCAN:")
    nav = only(some(F.slice(F.split(F.substring("line", 3, 1 << 30), ","), 3, 1 << 20)), "NAV_DATA:")
    own = own.withColumns({"raw": raw, "t": only(t, "RPCS_PRES:", "PFC_DB:", "RFC_DB:", "LCS_TEMP:"), "some": few, "nav": nav})
    if "RPCS:" in kinds:
        own = own.withColumn("words", only(F.array(*[F.split_part(_at("raw", 5 + 2 * k), F.lit(" "), F.lit(3)) for k in range(7)]), "RPCS:"))
        own = own.withColumn("words", only(clean.word_bits(F.col("words"), 7), "RPCS:"))
    if "RPCS_PRES:" not in kinds:
        return own
    own = own.withColumn("p1", F.when((F.col("kind") == "RPCS_PRES:") & (F.size("t") >= 5), _mark("PRI_HI", F.lit(5))).otherwise(0))
    return own.withColumn("p2", _mark("SEC_HI", F.col("p1"))).withColumn("p3", _mark("MAN_PRE", F.col("p2")))


def records(lines: DataFrame) -> DataFrame:
    """The lines of known types: content_hash, pos, kind, skip, wide (whether it has the right width) and broken.

    ``broken`` has a bit for each whole number that makes null of its file's column.
    """
    skip = ~F.coalesce(_by_kind(lambda _, r: r.readable()), F.lit(False))
    broken = _by_kind(lambda name, r: _bits(r.values(), name), [name for name in RECORDS if any(k == name for k, _ in BITS)])
    own = _cut(lines, list(RECORDS)).withColumns({"skip": skip, "wide": F.coalesce(_by_kind(lambda _, r: r.wide()), F.lit(False))})
    return own.select("content_hash", "pos", "kind", "skip", "wide", F.coalesce(F.when(~F.col("skip") & F.col("wide"), broken), F.lit(0).cast("bigint")).alias("broken"))


def _numbers(artifact: str) -> list[int]:
    """The places of an output's columns of whole numbers among its records' values."""
    return [k for k, f in enumerate(LEAVES[artifact][1].fields[2:]) if isinstance(f.dataType, (T.IntegerType, T.LongType))]


#: Of each whole number of a record type, its bit in ``broken``.
BITS = {p: bit for bit, p in enumerate((name, k) for name, (output, _) in RECORDS.items() for k in _numbers(f"mcdata.{output}"))}


def _bits(values: list[Column], name: str) -> Column:
    own = [(values[k], bit) for (kind_, k), bit in BITS.items() if kind_ == name]
    out = F.lit(0).cast("bigint")
    for x, bit in own:
        out = out.bitwiseOR(F.when(clean.broken_int(x), F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint"))
    # most records have plain digits alone, which are told by one look
    return F.when(F.concat_ws(",", *[x for x, _ in own]).rlike(r"^(?:[+-]?[0-9]{1,15}(?:,|\z))+\z"), F.lit(0).cast("bigint")).otherwise(out)


def decided(own: DataFrame) -> DataFrame:
    """Files of which something is to be told: ``bad`` (one holds a record that can't be), and the ``broken`` numbers of its records.

    Only records that tell something are sent. The fence keeps the predicate from being moved to where the parts
    of lines are made, which would make them again.
    """
    own = own.select("content_hash", (~F.col("skip") & ~F.col("wide")).alias("bad"), "broken")
    return fenced(own, "content_hash").filter("bad or broken <> 0").groupBy("content_hash").agg(F.bool_or("bad").alias("bad"), F.bit_or("broken").alias("broken"))


#: Told files up to which every task gets them all.
FEW = 100_000


def _told(files: DataFrame, told: DataFrame) -> DataFrame:
    """The files that aren't bad, with their ``broken`` numbers. Contents are never sorted, and sent only if very much is told."""
    n = told.count()
    if not n:
        return files.withColumn("broken", F.lit(0).cast("bigint"))
    both = files.join(told.hint("broadcast" if n <= FEW else "shuffle_hash"), "content_hash", "left")
    return both.filter("not coalesce(bad, false)").select("content_hash", "content", F.coalesce("broken", F.lit(0).cast("bigint")).alias("broken"))


def record_output(files: DataFrame, told: DataFrame, name: str) -> DataFrame:
    """Typed rows of one output from its records in the files that aren't bad."""
    output, record = RECORDS[name]
    schema = LEAVES[f"mcdata.{output}"][1]
    rows = text.ended_lines(_told(files, told), "broken")
    good = fenced(_cut(rows, [name]), "pos").filter(record.readable())
    broken = lambda k: F.col("broken").bitwiseAND(F.lit(1 << BITS[name, k]).cast("bigint")) != 0 if (name, k) in BITS else F.lit(False)
    columns = [(x if record.ready and k else clean.typed(x, f.dataType, broken(k))).alias(f.name) for k, (x, f) in enumerate(zip(record.values(), schema.fields[2:], strict=True))]
    return conform(good.select("content_hash", F.col("pos").alias(schema.fields[1].name), *columns), schema)


def parse_mcdata(files: DataFrame) -> Parsed:
    """Nine outputs of mission computer data; line numbers begin at 0.

    The files are written, as ten passes read them. The first finds what a file decides for all of its records, which
    is a row for each file of which there is something to tell; then each output reads the lines of its own kind.
    No record is sent or sorted but those that tell something.
    """
    own = written(files)
    told = written(decided(records(text.ended_lines(own))))
    outputs = {f"mcdata.{output}": partial(record_output, own, told, name) for name, (output, _) in RECORDS.items()}
    return Parsed(Outputs(outputs), told.filter("bad").select("content_hash", F.lit("a record has too few or too many fields").alias("message")))


def parse_segments(files: DataFrame) -> Parsed:
    """Segments; line numbers begin at 1. A file that isn't UTF-8, holds a malformed time or no full row fails.

    What fails a file is looked for in the array of its lines, before they become rows.
    """
    invalid = files.filter(~F.is_valid_utf8(F.col("content").cast("string"))).select("content_hash", F.lit("not UTF-8").alias("message"))
    part = lambda t, k: F.when(F.size(t) > k + 1, _at(t, k))

    def row(x: Column, size: Column) -> Column:
        t = lambda k: part(x, k)
        given = (F.coalesce(t(3), F.lit("")) != "").alias("a"), (F.coalesce(t(4), F.lit("")) != "").alias("b")
        return F.struct((size >= 14).alias("whole"), *given, t(1).alias("group"), clean.to_fine_time(t(3)).alias("start"), clean.to_fine_time(t(4)).alias("stop"), t(12).alias("status"))

    # each time is read once; the fence keeps predicates from reading them again
    cut = files.select("content_hash", text.text_of(F.col("content"), "strict").alias("text")).select("content_hash", F.transform(text.bare_lines(F.col("text")), lambda x: F.split(x, ",", 14)).alias("cut"))
    own = fenced(cut.select("content_hash", F.transform("cut", lambda x: row(x, F.size(x))).alias("lines")), "content_hash").filter(F.size("lines") > 0)
    wrong = lambda r: (r["a"] & r["start"].isNull()) | (r["b"] & r["stop"].isNull())
    own = fenced(own.withColumns({"short": ~F.exists("lines", lambda r: r["whole"]), "bad": F.exists("lines", wrong)}), "content_hash")
    rows = own.filter("not short and not bad").select("content_hash", F.posexplode("lines").alias("pos", "r"))
    rows = rows.select("content_hash", (F.col("pos") + 1).alias("line_number"), F.col("r.group").try_cast("int").alias("group"), F.col("r.start").alias("event_start"), F.col("r.stop").alias("event_stop"), F.col("r.status").alias("flight_status"))
    failed = own.filter("short or bad").select("content_hash", F.when(F.col("short"), "no row has all fields").otherwise("a time is malformed").alias("message"))
    return Parsed({"segments": conform(rows, LEAVES["segments"][1])}, failed.unionByName(invalid))


def parse_engine(files: DataFrame) -> Parsed:
    """Engine times; blank lines aren't numbered, numbers begin at 1."""
    files = written(files)  # read twice
    fields = F.transform(F.slice("fields", 1, 6), lambda x: F.when(~x.isin(clean.NO_VALUE), x))
    own = text.delimited(files, "strict", skip_blank=True).withColumn("f", fields)
    f = F.col("f")
    rows = own.filter(_at(f, 0) == "ENG_TIME").select("content_hash", (F.col("pos") + 1).alias("line_number"), _at(f, 1).alias("engine_position"), clean.to_fine_time(_at(f, 2)).alias("start_time"), clean.to_fine_time(_at(f, 3)).alias("stop_time"), clean.seconds(_at(f, 4)).alias("run_time_seconds"))
    invalid = files.filter(~F.is_valid_utf8(F.col("content").cast("string"))).select("content_hash", F.lit("not UTF-8").alias("message"))
    return Parsed({"engine_on_off": conform(rows, LEAVES["engine_on_off"][1])}, invalid)


def parse_tmptr(files: DataFrame) -> Parsed:
    """Temperatures; records of fewer than six fields and those without a time are left out, numbers begin at 1."""
    f = F.col("fields")
    files = written(files)  # read twice
    own = text.delimited(files, "replace").filter(F.size("fields") >= 6).withColumn("at", clean.log_time(_at(f, 1), _at(f, 2))).filter("at is not null")
    rows = own.select("content_hash", (F.col("pos") + 1).alias("line_number"), _at(f, 0).alias("afmc"), F.col("at").alias("datetime"), _at(f, 3).alias("category"), clean.temperature("F", _at(f, 4), _at(f, 5)).alias("temp_f"), clean.temperature("C", _at(f, 4), _at(f, 5)).alias("temp_c"))
    none = files.select("content_hash", F.lit("").alias("message")).limit(0)
    return Parsed({"tmptr_log": conform(rows, LEAVES["tmptr_log"][1])}, none)


PARSERS: dict[str, Callable[[DataFrame], Parsed]] = {"mcdata": parse_mcdata, "segments": parse_segments, "engine_on_off": parse_engine, "tmptr_log": parse_tmptr}
