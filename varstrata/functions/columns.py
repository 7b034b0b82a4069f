"""Column roles and the scalar expressions shared by every operator."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAN = float("nan")
INFINITY = float("inf")


def quoted(name: str) -> str:
    """Back-quote a user column name: names such as ``District.Name`` hold dots."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def as_names(names: str | Sequence[str]) -> list[str]:
    """Accept ``"a,b"`` or ``["a", "b"]``."""
    parts = names.split(",") if isinstance(names, str) else list(names)
    return [part.strip() for part in parts]


@dataclass(frozen=True)
class Roles:
    """Which columns of a table are stratum keys, measure and payload."""

    keys: tuple[str, ...]
    measure: str | None
    payload: tuple[str, ...]


def resolve(columns: Sequence[str], names: str | Sequence[str]) -> list[str]:
    """Match names to columns, ignoring case, in the order the caller gave.

    An exact match wins; an unknown or ambiguous name raises ``ValueError``.
    """
    found = []
    for name in as_names(names):
        same = [c for c in columns if c == name] or [c for c in columns if c.lower() == name.lower()]
        if not same:
            raise ValueError(f"unknown column {name!r}; the table has {', '.join(columns)}")
        if len(same) > 1:
            raise ValueError(f"column name {name!r} is ambiguous: {', '.join(same)}")
        if same[0] not in found:
            found.append(same[0])
    return found


def resolve_roles(
    columns: Sequence[str],
    keys: str | Sequence[str],
    measure: str | None = None,
    *,
    payload: str = "once",
) -> Roles:
    """Split a table's columns into keys, measure and payload.

    ``payload="once"`` lists every non-key column once. ``payload="per_key"`` lists, for each key
    in turn, all columns other than that key, so a composite key repeats columns and includes the
    other keys.
    """
    key_names = resolve(columns, keys)
    if not key_names:
        raise ValueError("at least one key column is needed")
    measure_name = resolve(columns, [measure])[0] if measure is not None else None
    if measure_name is not None and measure_name in key_names:
        raise ValueError(f"measure {measure_name!r} is also a key")
    if payload == "once":
        rest = [c for c in columns if c not in key_names]
    elif payload == "per_key":
        rest = [c for key in key_names for c in columns if c != key]
    else:
        raise ValueError("payload must be 'once' or 'per_key'")
    return Roles(tuple(key_names), measure_name, tuple(rest))


def stratum_label(keys: Sequence[str]) -> Column:
    """The key values joined with commas: for display and record formats, never for grouping."""
    return F.concat_ws(",", *[F.coalesce(col(k).cast("string"), F.lit("")) for k in keys])


def payload_text(names: Sequence[str]) -> Column:
    """Payload values joined with commas; a null is written as an empty field."""
    return F.concat_ws(",", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in names])


CONTROLS_AND_BLANK = "".join(chr(c) for c in range(0x21))
FIELD_BREAK = "\uffff"  # a code point that is never a character


def strip_controls(text: Column) -> Column:
    """Remove every leading and trailing character up to U+0020, not only blanks."""
    return F.btrim(text, F.lit(CONTROLS_AND_BLANK))


def split_quoted(line: Column) -> Column:
    """Split a line at commas outside double quotes, then delete all double quotes.

    A comma is outside if an even number of quotes follows it. Trailing empty fields are kept. The
    line is cut at its quotes, so that its length counts once however many fields it has.
    """
    pieces = F.split(strip_controls(line), '"', -1)

    def unquoted(parts: Column) -> Column:
        last = F.size(parts) - 1
        marked = F.transform(
            parts,
            lambda part, i: F.when((last - i) % 2 == 0, F.translate(part, ",", FIELD_BREAK)).otherwise(part),
        )
        return F.split(F.array_join(marked, ""), FIELD_BREAK, -1)

    # inside the lambda the pieces are a variable, not an expression repeated for every piece
    return F.transform(F.array(pieces), unquoted)[0]


def read_double(text: Column) -> Column:
    """Parse text as a double; null if it is none.

    ``NaN`` and ``Infinity`` are numbers only in that spelling; ``nan`` or ``inf`` are not numbers.
    """
    trimmed = strip_controls(text)
    value = trimmed.try_cast("double")
    spelled = trimmed.rlike(r"^[+-]?(NaN|Infinity)$")
    # the patterns are tried only on the rare values that are not finite numbers
    return (
        F.when(value.isNotNull() & is_finite(value), value)
        .when(trimmed.rlike(r"^[+-]?NaN$"), F.lit(NAN))
        .when(spelled | ~trimmed.rlike(r"(?i)^[+-]?(inf|infinity|nan)$"), value)
    )


def lenient_double(text: Column) -> Column:
    """Parse text as a double; what cannot be parsed becomes 0.0."""
    return F.coalesce(read_double(text), F.lit(0.0))


def measure_value(df: DataFrame, name: str, bad_measure: str = "zero") -> Column:
    """The measure as a double.

    ``bad_measure="zero"`` counts a missing or unreadable value as the observation 0.0;
    ``"drop"`` turns just those into null, so that the caller can leave the row out.
    """
    if bad_measure not in ("zero", "drop"):
        raise ValueError("bad_measure must be 'zero' or 'drop'")
    value = read_double(col(name)) if dict(df.dtypes)[name] == "string" else col(name).cast("double")
    return value if bad_measure == "drop" else F.coalesce(value, F.lit(0.0))


def ieee_divide(a: Column, b: Column) -> Column:
    """Division that yields NaN or infinity for a zero divisor instead of an ANSI error."""
    by_zero = F.when((a == 0) | F.isnan(a), F.lit(NAN)).otherwise(a * F.lit(INFINITY))
    return F.when(b == 0, by_zero).otherwise(a / b)


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) != F.lit(INFINITY))


def variation(mean: Column, sd: Column, *, weight=1.0, degenerate: str = "zero", abs_mean: bool = False) -> Column:
    """gamma_i = sqrt(weight) * sd / mean, the weighted coefficient of variation of a stratum.

    ``degenerate="zero"`` gives 0 where the mean is 0 or the ratio is not finite, so one bad
    stratum cannot empty the whole sample; ``"propagate"`` keeps NaN and infinity.
    """
    if degenerate not in ("zero", "propagate"):
        raise ValueError("degenerate must be 'zero' or 'propagate'")
    weight = weight if isinstance(weight, Column) else F.lit(float(weight))
    centre = F.abs(mean) if abs_mean else mean
    ratio = ieee_divide(F.sqrt(weight) * sd, centre)
    if degenerate == "propagate":
        return ratio
    # without deviation it is 0, not the -0.0 of a negative mean
    return F.when((mean != 0) & (sd != 0) & is_finite(ratio), ratio).otherwise(F.lit(0.0))


def quota(gamma: Column, total_gamma: Column, m: float, *, degenerate: str = "zero") -> Column:
    """s_i = M * (gamma_i / gamma) rounded half up; an undefined share gives 0."""
    share = F.lit(float(m)) * ieee_divide(gamma, total_gamma)
    undefined = F.isnan(share) if degenerate == "propagate" else F.isnan(share) | (total_gamma == 0)
    return F.when(undefined, F.lit(0).cast("bigint")).otherwise(F.floor(share + F.lit(0.5)).cast("bigint"))
