"""Cleaning rules as Column -> Column functions; all of them stay in JVM code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schemas as S


def quoted(name: str) -> Column:
    """Column by its literal name, whatever dots, blanks or back-ticks it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def null_na(c: Column) -> Column:
    """Cell texts that a spreadsheet reader takes for missing become NULL."""
    return F.when(~c.isin(*S.NA_TOKENS), c)


def strip_ws(c: Column) -> Column:
    # btrim with a character set: Spark's plain trim only knows U+0020, and a regex costs more.
    return F.btrim(c.cast("string"), F.lit(S.WHITESPACE))


def strip_fields(df: DataFrame, *names: str) -> DataFrame:
    """The named text columns trimmed as by `strip_ws`, at about a third of its cost.

    Spaces go first, which is cheap. Only texts that then begin or end with something other than
    a printable ASCII character go through the full set of whitespace. Two projections, since
    the second refers to the first's result several times.
    """
    ticked = {n: "`" + n.replace("`", "``") + "`" for n in df.columns}
    spaced = df.selectExpr(*[f"trim(cast({t} AS string)) AS {t}" if n in names else t
                             for n, t in ticked.items()])
    whole = ("CASE WHEN {0} >= '!' AND {0} < '\x7f' AND right({0}, 1) >= '!' "
             "AND right({0}, 1) < '\x7f' THEN {0} ELSE btrim({0}, '" + S.WHITESPACE + "') END AS {0}")
    return spaced.selectExpr(*[whole.format(t) if n in names else t for n, t in ticked.items()])


def known(c: Column, stripped: bool = False) -> Column:
    """Trimmed text, or NULL where blank.

    The text occurs twice in the expression. Table transforms trim in projections of their own
    (`strip_fields`) and pass `stripped=True`, so that it is done once per row.
    """
    text = c if stripped else strip_ws(c)
    return F.when(~text.isin("", *S.BLANK_TOKENS), text)


def blank_str(c: Column, stripped: bool = False) -> Column:
    """Trimmed text, with every kind of blank as ''."""
    return F.coalesce(known(c, stripped), F.lit(""))


def clean_text(c: Column, default: str, stripped: bool = False) -> Column:
    """Trimmed text, or `default` where blank; never NULL, so joins add no NULL checks."""
    return F.coalesce(known(c, stripped), F.lit(default))


def clean_category(c: Column, stripped: bool = False) -> Column:
    """C2"""
    return F.upper(clean_text(c, S.UNCATEGORISED, stripped))


def clean_brand(category: Column, brand: Column, house_category: str = S.HOUSE_CATEGORY,
                stripped: bool = False) -> Column:
    """`category` is compared and quoted in its trimmed upper-case form."""
    cat = category if stripped else F.upper(strip_ws(category))
    house = house_category.strip().upper()
    unbranded = F.when(cat == house, F.lit(house)).otherwise(
        F.concat(cat, F.lit(S.UNBRANDED_SUFFIX)))
    return F.coalesce(F.upper(known(brand, stripped)), unbranded)


def clean_channel(c: Column, stripped: bool = False) -> Column:
    """C5 + C9 for the sales channel."""
    return F.upper(clean_text(c, S.UNSPECIFIED, stripped))


def clean_product_no(c: Column, row_id: Column | None, stripped: bool = False) -> Column:
    """C4: blank numbers become UNSPECIFIED-<row position>.

    A source without row positions may still be cleaned as long as no number is blank; a blank
    one then fails the job rather than yielding a made-up or NULL key.
    """
    if row_id is None:
        placeholder = F.raise_error(F.lit("blank product number in a source without row ids"))
        return F.coalesce(known(c, stripped), placeholder.cast("string"), F.lit(""))
    placeholder = F.concat(F.lit(S.PRODUCT_PLACEHOLDER_PREFIX), row_id.cast("string"))
    return F.coalesce(known(c, stripped), placeholder)


def parse_date(c: Column, dtype: T.DataType, pattern: str = S.DATE_PATTERN) -> Column:
    """Text that is no such date becomes NULL; real dates and timestamps pass through."""
    return F.try_to_date(c, pattern) if isinstance(dtype, T.StringType) else c


def too_large(c: Column) -> Column:
    """Numbers that the staged number type cannot hold; false for everything else."""
    size = F.abs(c.try_cast("double"))
    limit = 10.0 ** (S.NUMBER.precision - S.NUMBER.scale)
    return F.coalesce((size >= limit) & (size < float("inf")), F.lit(False))


def to_number(c: Column) -> Column:
    """NULL for what is no number. One too large for the staged type fails the job: a wrong
    amount would be published otherwise. The quality report counts those beforehand."""
    refuse = F.raise_error(F.concat(F.lit("number too large for "), F.lit(S.NUMBER.simpleString()),
                                    F.lit(": "), c.cast("string")))
    return F.coalesce(c.try_cast(S.NUMBER), F.when(too_large(c), refuse.cast(S.NUMBER)))


def to_whole(c: Column) -> Column:
    """C7 for counts: by way of a decimal, as text such as 2.0 is no integer to Spark."""
    return F.round(to_number(c)).try_cast("int")


def zero_filled(c: Column) -> Column:
    """C8"""
    return F.coalesce(to_number(c), F.lit(0).cast(S.NUMBER))
