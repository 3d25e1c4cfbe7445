"""Column expressions that clean raw extracts and derive labels (PR*).

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen.  Dirty input never raises under ANSI mode: parsing uses ``try_*``.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's labels for the same results)
# ---------------------------------------------------------------------------
SECOND_HAND_LABEL = "Second-Hand Dwelling house /Apartment"
NEW_DWELLING_LABEL = "New Dwelling house /Apartment"
SECOND_HAND_MARKER = "Ath"
NEW_DWELLING_MARKER = "Nua"
VAT_EXCLUSIVE = "VAT Exclusive"
VAT_INCLUSIVE = "VAT Inclusive"
NOT_RECORDED = "Not recorded"
NO_DECISION = "No decision recorded"

# Decision outcome rules, checked in this order; the first rule that matches
# wins.  A rule matches when the upper-cased decision text contains any of
# its keywords.  Texts equal to one of NO_DECISION_TEXTS (or NULL) are
# "No decision recorded"; anything unmatched is "Other".
NO_DECISION_TEXTS = ("Not recorded", "N/A")
DECISION_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Invalid", ("INVA",)),
    ("Withdrawn", ("WITHDRAW",)),
    ("Split decision", ("SPLIT",)),
    ("Refused", ("REFUS",)),
    ("Granted", ("GRANT", "CONDITIONAL", "APPROV")),
    ("Exempt", ("EXEMPT",)),
    ("Further information", ("ADDITIONAL INFORMATION", "FURTHER INFORMATION",
                             "REQUEST AI", "REQ AI")),
)
OTHER_OUTCOME = "Other"

# Local authorities that do not follow the "<County> County Council" naming,
# with the county each belongs to.  All other names lose a trailing
# " County Council".
AUTHORITY_COUNTY = {
    "Dublin City Council": "Dublin",
    "Dún Laoghaire Rathdown County Council": "Dublin",
    "Fingal County Council": "Dublin",
    "South Dublin County Council": "Dublin",
    "Cork City Council": "Cork",
    "Cork County Council": "Cork",
    "Galway City Council": "Galway",
    "Galway County Council": "Galway",
    "Limerick City & County Council": "Limerick",
    "Waterford City & County Council": "Waterford",
}
COUNTY_COUNCIL_SUFFIX = " County Council$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- PR3 / PR4 / PR5 / PR6 : parsing and casts ------------------------------
def clean_price(c, precision: int = 18, scale: int = 2) -> Column:
    """Keep digits and the dot only, then decimal; unparsable → NULL."""
    digits = F.regexp_replace(_c(c), r"[^0-9.]", "")
    return F.nullif(digits, F.lit("")).try_cast(f"decimal({precision},{scale})")


def parse_date(c, fmt: str = "dd/MM/yyyy") -> Column:
    return F.try_to_date(_c(c), fmt)


def parse_iso_timestamp(c, fmt: str = "yyyy-MM-dd'T'HH:mm:ss.SSSX") -> Column:
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def cast_int(c) -> Column:
    return _c(c).try_cast("int")


def cast_long(c) -> Column:
    return _c(c).try_cast("bigint")


def cast_date(c) -> Column:
    return _c(c).cast("date")


def cast_decimal(c, precision: int, scale: int) -> Column:
    return _c(c).try_cast(f"decimal({precision},{scale})")


# --- PR7 - PR13 : flags and labels -------------------------------------------
def invert_flag(c) -> Column:
    """"Not full market price" → "is full market price": No → Yes, else No."""
    return F.when(_c(c) == "No", "Yes").otherwise("No")


def normalise_property_type(c) -> Column:
    """Irish-language descriptions → English labels; first marker wins."""
    col = _c(c)
    return (F.when(col.contains(SECOND_HAND_MARKER), SECOND_HAND_LABEL)
            .when(col.contains(NEW_DWELLING_MARKER), NEW_DWELLING_LABEL)
            .otherwise(col))


def sale_type(vat_flag) -> Column:
    """A truthy VAT flag (boolean or "Yes"/"true" text) → VAT Exclusive."""
    flag = _c(vat_flag).try_cast("boolean")
    return F.when(flag, VAT_EXCLUSIVE).otherwise(VAT_INCLUSIVE)


def tri_state_label(c, yes: str = "Yes", no: str = "No",
                    missing: str = NOT_RECORDED) -> Column:
    col = _c(c)
    return F.when(col, yes).when(~col, no).otherwise(missing)


def tri_state_flag(c) -> Column:
    return _c(c).cast("int")


def null_to_label(c, label: str = NOT_RECORDED) -> Column:
    return F.coalesce(F.trim(_c(c)), F.lit(label))


def null_to_unknown_key(c, unknown: int = 0) -> Column:
    return F.coalesce(_c(c).cast("int"), F.lit(unknown))


def constant_count() -> Column:
    return F.lit(1).cast("int")


def truncate_text(c, n: int = 4000) -> Column:
    return F.substring(_c(c), 1, n)


# --- PR14 / PR15 : decision outcome ---------------------------------------------
def decision_outcome(c, rules: Sequence[tuple[str, Sequence[str]]] = DECISION_RULES,
                     no_decision_texts: Iterable[str] = NO_DECISION_TEXTS) -> Column:
    col = _c(c)
    text = F.upper(col)

    def any_kw(words):
        return reduce(lambda a, b: a | b, [text.contains(w) for w in words])

    expr = F.when(col.isNull() | col.isin(*no_decision_texts), F.lit(NO_DECISION))
    for outcome, words in rules:
        expr = expr.when(any_kw(words), F.lit(outcome))
    return expr.otherwise(F.lit(OTHER_OUTCOME))


def decision_recorded(outcome) -> Column:
    return F.when(_c(outcome) == NO_DECISION, 0).otherwise(1)


# --- PR16 : local authority → county -----------------------------------------------
def local_authority_to_county(c, mapping: Mapping[str, str] | None = None) -> Column:
    """Named authorities via a literal map, others by stripping the suffix."""
    mapping = AUTHORITY_COUNTY if mapping is None else mapping
    col = _c(c)
    stripped = F.regexp_replace(col, COUNTY_COUNCIL_SUFFIX, "")
    if not mapping:
        return stripped
    lit_map = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(lit_map, col), stripped)


def map_county_frame(df: DataFrame, authority_col: str, mapping: DataFrame,
                     out: str = "County") -> DataFrame:
    """PR16 with a mapping *table* (authority, county).

    The mapping is a code table (one row per authority), joined left; the
    planner broadcasts it when its runtime size is under the threshold.
    """
    m = mapping.toDF("_auth", "_county")
    return (df.join(m, df[authority_col] == m["_auth"], "left")
            .withColumn(out, F.coalesce(F.col("_county"),
                                        F.regexp_replace(F.col(authority_col),
                                                         COUNTY_COUNCIL_SUFFIX, "")))
            .drop("_auth", "_county"))


# --- PR17 : audit columns --------------------------------------------------------------
def add_audit_columns(df: DataFrame, source: str | None = None, load_ts=None,
                      load_date=None, ts_col: str = "LoadTimestamp",
                      source_col: str = "SourceSystem",
                      date_col: str | None = None) -> DataFrame:
    """Stamp a run: one timestamp for the whole run (S13), a source label and
    optionally a load date.  A given ``load_ts`` is a zone-free wall-clock
    stamp (like the warehouse's datetime2), so it does not move with the
    session time zone; the default is ``current_timestamp``."""
    ts = (F.current_timestamp() if load_ts is None
          else F.lit(load_ts).cast("timestamp_ntz"))
    cols = {ts_col: ts}
    if source is not None:
        cols[source_col] = F.lit(source)
    if date_col is not None:
        cols[date_col] = (ts.cast("date") if load_date is None
                          else F.lit(load_date).cast("date"))
    return df.withColumns(cols)
