"""Price segments: the configuration, the segment rule as one CASE
expression, and display labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Segment:
    name: str
    price_min: float
    price_max: float
    description: str = ""


# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's): the three price segments in
# order with their half-open USD ranges and descriptions, the Spanish display
# names, and the validation / defaulting constants for requests.
# ---------------------------------------------------------------------------
DEFAULT_SEGMENTS: tuple[Segment, ...] = (
    Segment("budget", 30000, 120000, "Budget properties - first-time buyers, small apartments"),
    Segment("mid_range", 120000, 300000, "Mid-range properties - majority of market, families, professionals"),
    Segment("premium", 300000, 600000, "Premium properties - luxury apartments, penthouses, premium neighborhoods"),
)

SEGMENT_NAMES_ES = {"budget": "Económico", "mid_range": "Medio", "premium": "Premium"}
# ---------------------------------------------------------------------------

SEGMENT_SCHEMA = T.StructType([
    T.StructField("ord", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("price_min", T.DoubleType(), False),
    T.StructField("price_max", T.DoubleType(), False),
    T.StructField("description", T.StringType(), True),
])


def segment_expr(price: Column | str = "price", segments=DEFAULT_SEGMENTS) -> Column:
    """First segment with ``min <= price < max``; a price exactly at the last
    segment's max belongs to the last segment; anything else is NULL (P5)."""
    p = F.col(price) if isinstance(price, str) else price
    expr = None
    for s in segments:
        cond = (p >= F.lit(float(s.price_min))) & (p < F.lit(float(s.price_max)))
        expr = F.when(cond, F.lit(s.name)) if expr is None else expr.when(cond, F.lit(s.name))
    last = segments[-1]
    return expr.when(p == F.lit(float(last.price_max)), F.lit(last.name))


def segments_df(spark: SparkSession, segments=DEFAULT_SEGMENTS) -> DataFrame:
    """The segment table (3 rows by default). Size is bounded by the
    configuration, so joins against it may broadcast it."""
    rows = [(i, s.name, float(s.price_min), float(s.price_max), s.description)
            for i, s in enumerate(segments)]
    return spark.createDataFrame(rows, SEGMENT_SCHEMA)


def money0(x: Column) -> Column:
    """``{:,.0f}``: thousands separators, no decimals, half-even."""
    return F.format_number(x.cast("double"), 0)


def price_range_api(pmin: Column, pmax: Column) -> Column:
    """``$30,000-$120,000`` as returned by the JSON endpoint."""
    return F.concat(F.lit("$"), money0(pmin), F.lit("-$"), money0(pmax))


def price_range_display(pmin: Column, pmax: Column) -> Column:
    """``$30,000 - $120,000`` as shown in the form."""
    return F.concat(F.lit("$"), money0(pmin), F.lit(" - $"), money0(pmax))


def spanish_name(name: Column) -> Column:
    """Spanish display name, falling back to the segment name."""
    m = F.create_map(*[x for k, v in SEGMENT_NAMES_ES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[name], name)


def segment_display(name: Column, pmin: Column, pmax: Column) -> Column:
    """``Económico ($30,000 - $120,000)``."""
    return F.concat(spanish_name(name), F.lit(" ("), price_range_display(pmin, pmax), F.lit(")"))


def price_display(price: Column, locale: str = "en") -> Column:
    """``$150,000 USD`` (form result, P19); ``locale='es-AR'`` gives the
    browser's grouping with dots and no decimals, ``US$ 150.000`` (P21)."""
    if locale == "es-AR":
        return F.concat(F.lit("US$ "), F.translate(money0(price), ",", "."))
    return F.concat(F.lit("$"), money0(price), F.lit(" USD"))
