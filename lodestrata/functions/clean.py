"""Text to typed values, as in the log formats; what can't be read is null, and nothing raises."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIGITS = r"^[+-]?[0-9]{1,15}$(?!\n)"
_DATE = r"^([0-9]{1,2})/([0-9]{1,2})/((?!0000)[0-9]{4}) ([0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})"
BLANKS = " \t\n\r\x0b\x0c"
_FLOAT = r"^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?)$"
#: What a delimited file means by no value.
NO_VALUE = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def strip(x: Column) -> Column:
    return F.trim(x, F.lit(BLANKS))


def to_float(x: Column) -> Column:
    """Plain or exponent notation and infinities, blanks around them ignored."""
    s = strip(x)
    return F.when(s.rlike(_FLOAT), s.try_cast("double"))


def content_hash(content: Column) -> Column:
    """The MD5 of bytes (or of a text's UTF-8), as binary."""
    return F.unhex(F.md5(content))


def broken_int(x: Column) -> Column:
    """Whether a number has a fraction or is infinite, so that the whole column of its file is no integer."""
    v = to_float(x)
    # most numbers are plain digits, which are told by one look
    return F.when(x.rlike(_DIGITS), False).otherwise(F.coalesce((v != F.floor(v)) | (F.abs(v) == float("inf")), F.lit(False)))


def to_int(x: Column, broken: Column | None = None) -> Column:
    """A number without fraction; null where ``broken`` (of its whole column, as one broken value makes null of all)."""
    own = F.when(x.rlike(_DIGITS), x.try_cast("bigint")).when(~broken_int(x), to_float(x).try_cast("bigint"))
    return own if broken is None else F.when(~broken, own)


def to_time(x: Column) -> Column:
    """Month/day/year hour:minute:second, one or two digits each but the year."""
    return _iso(x, _DATE + r"\z", "$3-$1-$2 $4", F.substring(x, 12, 8))


def _iso(x: Column, rx: str, to: str, time: Column) -> Column:
    """``time`` is that of the form MM/dd/yyyy HH:mm:ss, which needs no replacing."""
    # a cast reads the standard form many times faster than a formatter reads another
    part = lambda at, n: F.substring(x, at, n)
    plain = F.concat(part(7, 4), F.lit("-"), part(1, 2), F.lit("-"), part(4, 2), F.lit(" "), time)
    return F.when(x.rlike(rx), F.when((part(3, 1) == "/") & (part(6, 1) == "/") & (part(14, 1) == ":") & (part(17, 1) == ":") & ~part(18, 2).contains(":"), plain).otherwise(F.regexp_replace(x, rx, to)).try_cast("timestamp_ntz"))


def to_fine_time(x: Column) -> Column:
    """As ``to_time`` with a fraction of one to nine digits after another colon, kept to microseconds."""
    return _iso(x, _DATE + r":([0-9]{1,9})\z", "$3-$1-$2 $4.$5", F.concat(F.substring(x, 12, 8), F.lit("."), F.substring(x, 21, 9)))


def to_bool(x: Column) -> Column:
    low = F.lower(x)
    return F.when(low.isin("true", "1", "t"), True).when(low.isin("false", "0", "f"), False)


def to_text(x: Column, mark_missing: bool = False) -> Column:
    """Stripped; None, nan and nothing are null, or ``<NA>`` with ``mark_missing``; only blanks are an empty text."""
    none = F.lit("<NA>") if mark_missing else F.lit(None).cast("string")
    s = strip(x)
    return F.when(x.isNull(), None).when(x.isin("None", "nan", ""), none).when(s.isin("None", "nan"), None).otherwise(s)


def seconds(x: Column) -> Column:
    """Hours:minutes:seconds as seconds; hours may have any number of digits."""
    s = strip(x)
    rx = r"^(\d+):([0-5]\d):([0-5]\d)$"
    part = lambda k: F.regexp_extract(s, rx, k).try_cast("bigint")
    return F.when(s.rlike(rx), part(1) * 3600 + part(2) * 60 + part(3))


def temperature(unit: str, first: Column, second: Column) -> Column:
    """The value of that unit (F or C, the last sign); the second reading replaces the first even if it can't be read."""
    last = lambda x: F.upper(F.substring(strip(x), -1, 1))
    value = lambda x: F.when(F.abs(v := to_float(F.regexp_replace(strip(x), "(?s).$", ""))) < 2**31, v.try_cast("int"))
    return F.when(last(second) == unit, value(second)).when(last(first) == unit, value(first))


def log_time(date: Column, time: Column) -> Column:
    """Eight digits and h:m:s.fraction; a year that begins with 00 is of this century."""
    d, t = strip(date), strip(time)
    ok = d.rlike(r"^\d{8}$") & t.rlike(r"^\d{2}:\d{2}:\d{2}\.\d{1,9}$")
    century = F.when(d.startswith("00"), "20").otherwise(F.substring(d, 1, 2))
    return F.when(ok, F.concat(century, F.substring(d, 3, 2), F.lit("-"), F.substring(d, 5, 2), F.lit("-"), F.substring(d, 7, 2), F.lit(" "), t).try_cast("timestamp_ntz"))


def carry_date(whole: Column, part: Column) -> Column:
    """``part``, with the date of ``whole`` before it if it is only a time."""
    return F.when((whole != "") & (part != "") & ~part.contains(" "), F.concat(F.substring_index(whole, " ", 1), F.lit(" "), part)).otherwise(part)


#: Scale and offset of each word of the pressure system.
WORDS = {"HUM_B": (1.26, -175.0), "SEC_HI_PRE": (0.51, -12.5), "HI_TEMP": (0.67, 38.0), "D_PRES": (0.05, -2.5), "HUM_A": (1.26, -175.0), "MAN_PRE": (0.51, -12.5), "PRI_HI_PRE": (0.51, -12.5)}


def word_bits(cells: Column, n: int) -> Column:
    """The bits of ``n`` binary words, without blanks at their ends; null for other signs than 0 and 1."""
    own = [F.get(cells, F.lit(k)) for k in range(n)]
    bare = [F.when((s := strip(x)).rlike("^[01]{1,63}$"), s) for x in own]
    # most records have plain words alone, which are told by one look
    return F.when(F.concat_ws(",", *own).rlike(r"^(?:[01]{1,63}(?:,|\z)){%d}\z" % n), cells).otherwise(F.array(*bare))


def word_value(name: Column, bits: Column) -> Column:
    """The value of a word from its ``word_bits``, to three digits; null for an unknown name."""
    scale, offset = (reduce(lambda out, k: out.when(name == k, WORDS[k][which]), list(WORDS)[1:], F.when(name == next(iter(WORDS)), next(iter(WORDS.values()))[which])) for which in (0, 1))
    return F.round(F.conv(bits, 2, 10).try_cast("bigint").cast("double") * scale + offset, 3)


def pressure(x: Column) -> Column:
    """CLR and nothing are null, INV is -1."""
    s = strip(x)
    return F.when(F.upper(s).isin("", "CLR"), None).when(F.upper(s) == "INV", "-1").otherwise(s)


def typed(x: Column, kind: T.DataType, broken: Column) -> Column:
    """The value of a record's field as the type of its column, which as one of numbers may be ``broken``."""
    if isinstance(kind, T.DoubleType):
        return F.nanvl(to_float(x), F.lit(None).cast("double"))
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return to_int(x, broken).try_cast(kind)
    if isinstance(kind, T.BooleanType):
        return to_bool(x)
    return to_time(x) if isinstance(kind, T.TimestampNTZType) else to_text(x)
