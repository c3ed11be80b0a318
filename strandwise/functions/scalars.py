"""Column builders for text, numbers, dates and identifiers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def q6(x: Column | str) -> Column:
    """Six decimals by floor(x * 1e6 + 0.5), which engines agree on where their round() does not."""
    x = F.col(x) if isinstance(x, str) else x
    return F.floor(x.cast("double") * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6)


def nullif_in(x: Column, words: Iterable[str]) -> Column:
    """Null where the trimmed text is one of `words`; each parser has its own set."""
    t = F.trim(x)
    return F.when(t.isin(*words), F.lit(None)).otherwise(t)


def as_bool(x: Column, yes: Iterable[str] = ("true", "yes", "on", "1")) -> Column:
    return F.coalesce(F.lower(F.trim(x)).isin(*yes), F.lit(False))


def whole(x: Column) -> Column:
    """A tolerant integer: text of an integer or a decimal, else null."""
    return x.try_cast("double").try_cast("bigint")


def sanitize_id(x: Column) -> Column:
    return F.regexp_replace(x, r"[^A-Za-z0-9_.-]+", "_")


def infer_run_id(path: Column) -> Column:
    """File name without folder and without .fastq or .fq, compressed or not."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.(fastq|fq)(\.(gz|bz2))?$", "")


def nested_path(name: Column) -> Column:
    """Letters, then the digits but the last in twos, then the last digit: AB00123 -> AB/00/12/3."""
    head = F.regexp_extract(name, r"^([A-Za-z]*)", 1)
    digits = F.regexp_extract(name, r"([0-9]*)$", 1)
    body = F.substring(digits, F.lit(1), F.greatest(F.lit(0), F.length(digits) - 1))
    return F.concat(head, F.lit("/"), F.regexp_replace(body, "(.{2})", "$1/"), F.when(F.length(body) % 2 == 1, F.lit("/")).otherwise(F.lit("")), F.substring(digits, -1, 1))


def parse_date_ordinal(text: Column) -> Column:
    """Days since 0001-01-01, plus 1: ISO dates, else D/M/Y unless only M/D/Y can be; 'baseline' is 0; else a first number."""
    t = F.lower(F.trim(text))
    iso = F.regexp_extract(t, r"^(\d{4})-(\d{1,2})-(\d{1,2})", 0)
    parts = [F.regexp_extract(t, r"^(\d{1,2})[/.](\d{1,2})[/.](\d{4})", i).try_cast("int") for i in (1, 2, 3)]
    iso_parts = [F.regexp_extract(t, r"^(\d{4})-(\d{1,2})-(\d{1,2})", i).try_cast("int") for i in (1, 2, 3)]
    day, month = parts[0], parts[1]
    swapped = (month > 12) & (day <= 12)
    dash = lambda y, m, d: F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")).try_cast("date")
    date = F.when(iso != "", dash(*iso_parts)).when(
        parts[2].isNotNull(), dash(parts[2], F.when(swapped, day).otherwise(month), F.when(swapped, month).otherwise(day))
    )
    ordinal = (F.datediff(date, F.lit("0001-01-01").cast("date")) + 1).cast("double")
    number = F.regexp_extract(t, r"(-?\d+(?:\.\d+)?)", 1).try_cast("double")
    return F.coalesce(ordinal, F.when(t.isin("baseline", "base", "start"), F.lit(0.0)), number)


def kv_map(text: Column, pair: str = ";", mid: str = "=") -> Column:
    """key=value pairs and bare flags; a flag's value is empty."""
    return F.map_from_entries(
        F.transform(
            F.filter(F.split(text, pair), lambda x: x != ""),
            lambda x: F.struct(F.substring_index(x, mid, 1).alias("key"), F.when(F.instr(x, mid) > 0, F.substring(x, F.instr(x, mid) + F.lit(len(mid)), F.length(x))).otherwise(F.lit("")).alias("value")),
        )
    )


def logsumexp(values: Column) -> Column:
    """Of an array of doubles."""
    top = F.array_max(values)
    return top + F.log(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + F.exp(x - top)))


def sig4(x: Column) -> Column:
    return F.format_string("%.4g", x)


def chained(x: Column, rules: Iterable[tuple[str, str]], default: str) -> Column:
    """The label of the first (fragment, label) whose fragment the text contains."""
    out = None
    for fragment, label in rules:
        hit = F.contains(x, F.lit(fragment))
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def lookup(x: Column, table: Mapping[str, str], default: Column | None = None) -> Column:
    """A small fixed table as one map constant."""
    m = F.create_map(*[F.lit(v) for kv in table.items() for v in kv])
    found = F.try_element_at(m, x)
    return F.coalesce(found, default) if default is not None else found
