"""Type and dialect detection of text data, over all rows and without sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.types import Split

# Date and time patterns in order of preference: pattern -> shape (fixed values).
DATES = {
    "yyyy-MM-dd": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "yyyy/MM/dd": r"^\d{4}/\d{1,2}/\d{1,2}$",
    "dd-MM-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}$",
    "dd/MM/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "MM/dd/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "yyyyMMdd": r"^\d{8}$",
}
TIMES = {
    "yyyy-MM-ddTHH:mm:ss": r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$",
    "ddMMMyyyy:HH:mm:ss": r"^\d{2}[A-Za-z]{3}\d{4}:\d{1,2}:\d{1,2}:\d{1,2}$",
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$",
}
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
INTEGER = r"^(-?[1-9][0-9]*|0)$"
DOUBLE = r"^-?\d+\.\d+$"
# Shortest text tried as a date, and the share of it that must be digits (fixed values).
MIN_DATE_LENGTH, MIN_DIGIT_SHARE = 8, 0.6
# Integers of so many digits fit 64 bits whatever the digits are.
SURE_DIGITS = 18
# Candidate delimiters in order of preference: name -> expression (fixed values).
DELIMITERS = {"comma": ",", "pipe": r"\|", "tab": r"\t", "tabs": r"\t+", "spaces": " +"}


def _iso_text(t: Column, pattern: str) -> Column:
    """Text of the pattern's shape, rewritten year first: Spark's casts read that without a formatter."""
    if pattern == "yyyyMMdd":
        return F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2))
    if pattern == "ddMMMyyyy:HH:mm:ss":
        month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.upper(F.substring(t, 3, 3)))
        day = F.concat_ws("-", F.substring(t, 6, 4), month.cast("string"), F.substring(t, 1, 2))
        return F.concat_ws(" ", day, F.substring(t, 11, 8))
    if pattern.startswith("yyyy"):
        return F.translate(t, "/", "-")
    part = lambda i: F.split_part(F.translate(t, "/", "-"), F.lit("-"), F.lit(i))
    month, day = (1, 2) if pattern.startswith("MM") else (2, 1)
    return F.concat_ws("-", part(3), part(month), part(day))


def _parsed(t: Column, pattern: str) -> Column:
    """Date or time of text that fits the pattern, else null."""
    kind, shape = ("date", DATES[pattern]) if pattern in DATES else ("timestamp_ntz", TIMES[pattern])
    return F.when(t.rlike(shape), _iso_text(t, pattern).try_cast(kind))


# What is left of a date or time without its digits (fixed values; a month name is any three letters).
RESTS = {"--": ("yyyy-MM-dd", "dd-MM-yyyy"), "//": ("yyyy/MM/dd", "dd/MM/yyyy", "MM/dd/yyyy"), "": ("yyyyMMdd",),
         "--T::": ("yyyy-MM-ddTHH:mm:ss",), "-- ::": ("yyyy-MM-dd HH:mm:ss",)}
MONTH_REST = "ddMMMyyyy:HH:mm:ss"


def _class_of(t: Column, rest: Column) -> Column:
    """Class of trimmed text, given what is left of it without its digits.

    That rest is the shape of the cell: it settles which few patterns are matched and parsed at all,
    and for most cells that none is.
    """
    digits = F.length(t) - F.length(rest)
    # Longer integers, such as some ids, have no number type that keeps them.
    whole = t.rlike(INTEGER) & ((digits <= SURE_DIGITS) | t.try_cast("bigint").isNotNull())
    number = F.when(rest.isin("", "-"), F.when(whole, "bigint").otherwise("string")).when(
        rest.isin(".", "-.") & t.rlike(DOUBLE), "double").otherwise("string")
    dated = None
    for shape, patterns in RESTS.items():
        found = F.when(_parsed(t, patterns[0]).isNotNull(), patterns[0])
        for p in patterns[1:]:
            found = found.when(_parsed(t, p).isNotNull(), p)
        dated = F.when(rest == shape, found) if dated is None else dated.when(rest == shape, found)
    dated = dated.when((F.length(rest) == 6) & rest.endswith(":::"), F.when(_parsed(t, MONTH_REST).isNotNull(), MONTH_REST))
    looks_dated = (F.length(t) >= MIN_DATE_LENGTH) & (digits > F.length(t) * MIN_DIGIT_SHARE)
    return F.when(F.coalesce(t, F.lit("")) == "", "").otherwise(F.coalesce(F.when(looks_dated, dated), number))


def _rest(t: Column) -> Column:
    return F.translate(t, "0123456789", "")


def classify(c: Column) -> Column:
    """Class of a cell: '', a date or time pattern, bigint, double or string."""
    return _class_of(F.trim(c), _rest(F.trim(c)))


def class_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (column, class, n): at most a dozen per column, counted in one scan."""
    cols = list(columns or df.columns)
    cells = df.selectExpr(*[f"trim(string(`{c}`)) AS `{c}`" for c in cols]).unpivot([], cols, "column", "cell")
    # The rest is made once per cell and used by all that follows.
    cells = cells.withColumn("rest", _rest(F.col("cell")))
    return cells.groupBy("column", _class_of(F.col("cell"), F.col("rest")).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (column, type): bigint, double, string or a date or time pattern."""
    counts = class_counts(df, columns)
    k = F.col("class")
    filled = k != ""
    has = lambda v: F.max(F.coalesce((k == v).cast("int"), F.lit(0))) == 1
    is_date = k.isin(list(DATES) + list(TIMES))
    votes = counts.groupBy("column").agg(
        F.count_if(filled).alias("classes"),
        F.max(F.when(filled, k)).alias("any_class"),
        has("string").alias("string"),
        has("bigint").alias("bigint"),
        has("double").alias("double"),
        has("yyyyMMdd").alias("compact"),
        F.count_if(is_date).alias("dates"),
        # At most nine entries: the date patterns.
        F.sort_array(F.collect_list(F.when(is_date, F.struct("n", "class"))), asc=False).alias("top"),
    )
    first, second = F.get("top", F.lit(0)), F.get("top", F.lit(1))
    return votes.select(
        "column",
        F.when(F.col("classes") == 0, "string")
        .when(F.col("classes") == 1, F.col("any_class"))
        .when(F.col("string"), "string")
        .when((F.col("classes") == 2) & F.col("compact") & F.col("bigint"), "bigint")
        .when(F.col("bigint") & F.col("double"), "double")
        .when((F.col("dates") == F.col("classes")) & (first["n"] > second["n"]), first["class"])
        .otherwise("string")
        .alias("type"),
    )


def types_of(inferred: DataFrame) -> dict[str, str]:
    """The inferred types as a dict: one entry per column."""
    return {r["column"]: r["type"] for r in inferred.collect()}


def cast_inferred(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast text columns to their inferred types; cells that do not fit become null."""
    out = {}
    for name, kind in types.items():
        c = F.trim(F.col(f"`{name}`").cast("string"))
        if kind in DATES or kind in TIMES:
            out[name] = _parsed(c, kind)
        else:
            out[name] = F.col(f"`{name}`").cast("string") if kind == "string" else c.try_cast(kind)
    return df.withColumns(out)


def _spread(lines: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Per pattern: the most common number of matches per line, and its deviation.

    Lines are first counted by number of matches, so the figures come from a small
    table of integers and are the same however the lines are split over tasks.
    """
    found = lines.select(
        *[F.regexp_count(F.col("value"), F.lit(p)).alias(name) for name, p in patterns.items()]
    ).unpivot([], list(patterns), "candidate", "hits")
    table = found.groupBy("candidate", "hits").agg(F.count(F.lit(1)).alias("n"))
    n, s1, s2 = F.sum("n"), F.sum(F.col("n") * F.col("hits")), F.sum(F.col("n") * F.col("hits") * F.col("hits"))
    var = (s2 - s1 * s1 / n) / (n - 1)
    return table.groupBy("candidate").agg(
        F.max_by("hits", F.struct("n", "hits")).alias("mode"),
        F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).otherwise(0.0).alias("deviation"),
    )


def detect_delimiter(lines: DataFrame) -> DataFrame:
    """One row (candidate, mode, deviation): the delimiter whose count per line varies least.

    What stands between quotes does not count.
    """
    plain = lines.select(F.regexp_replace("value", '"[^"]*"', "").alias("value"))
    order = F.array_position(F.array(*[F.lit(d) for d in DELIMITERS]), F.col("candidate"))
    return (
        _spread(plain, DELIMITERS)
        .where("mode <> 0")
        .orderBy("deviation", order)
        .limit(1)
    )


def detect_quoting(lines: DataFrame, delimiter: str) -> DataFrame:
    """One row (quoting): none, minimal, all or nonnumeric, from quotes that follow the delimiter."""
    rows = _spread(lines, {"sep": delimiter, "quoted": delimiter + '"'})
    one = rows.agg(
        F.max(F.when(F.col("candidate") == "sep", F.col("mode"))).alias("seps"),
        F.max(F.when(F.col("candidate") == "quoted", F.col("mode"))).alias("quotes"),
        F.max(F.when(F.col("candidate") == "quoted", F.col("deviation"))).alias("deviation"),
    )
    return one.select(
        F.when((F.col("quotes") == 0) & (F.col("deviation") == 0), "none")
        .when(F.col("deviation") > 0, "minimal")
        .when(F.col("seps") - F.col("quotes") == 0, "all")
        .otherwise("nonnumeric")
        .alias("quoting")
    )


def split_ragged(lines: DataFrame, delimiter: str) -> Split:
    """Lines with the usual number of columns, and the others. Delimiters inside quotes do not count."""
    plain = F.regexp_replace(F.col("value"), '"[^"]*"', "")
    hits = F.regexp_count(plain, F.lit(delimiter))
    usual = (
        lines.groupBy(hits.alias("hits"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.max_by("hits", F.struct("n", "hits")).alias("m"))
    )
    marked = lines.withColumn("_ok", hits == usual.scalar())
    return Split(marked.where("_ok").drop("_ok"), marked.where("NOT _ok").drop("_ok"))


def split_fields(lines: DataFrame, delimiter: str, names: Sequence[str]) -> DataFrame:
    """Text columns of the lines; quotes around a field are removed, quoted delimiters kept."""
    cut = F.split(F.col("value"), f'{delimiter}(?=(?:[^"]*"[^"]*")*[^"]*$)')
    field = lambda i: F.trim(F.regexp_replace(F.get(cut, F.lit(i)), '^"|"$', ""))
    return lines.select(*[field(i).alias(n) for i, n in enumerate(names)])
