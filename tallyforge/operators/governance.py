"""Column classification, tags and role-based masking.

* ``classify_columns`` profiles every string column in ONE aggregate pass:
  the share of non-NULL values that look like an e-mail address or an ISO
  3166 alpha-2 country code; categories above a threshold are reported with
  their privacy category. Names are not detected (they need an explicit tag).
* Tags live in ``StructField.metadata`` (``tag`` / ``tags``). Metadata survives
  plain column selection but not expressions: ``tag_lineage`` carries tags to derived
  columns and keeps them in the catalog's table.
* ``apply_masking`` rewrites every column tagged ``pii = 'Y'``: privileged
  roles see clear text; EMAIL columns keep their domain; anything else becomes
  ``****MASKED****`` (NULL included, as the policy's ELSE branch has no NULL
  test). Masking is a projection; ``tag_lineage.publish`` stores a table with views
  that mask by role.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# E-mail shape, privacy category per semantic category, masks.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[A-Za-z]{2,}$"
PRIVACY_BY_CATEGORY = {"EMAIL": "IDENTIFIER", "NAME": "IDENTIFIER", "COUNTRY": "QUASI_IDENTIFIER"}
MASK = "****MASKED****"
EMAIL_LOCAL_MASK = "****"
PRIVILEGED_ROLES = ("admin",)

SEMANTIC_TAG = "semantic_category"
PRIVACY_TAG = "privacy_category"
PII_TAG = "pii"


# ISO 3166-1 alpha-2 codes, each first letter with the second letters in use.
_COUNTRY_LETTERS = """
    A:DEFGILMOQRSTUWXZ B:ABDEFGHIJLMNOQRSTVWYZ C:ACDFGHIKLMNORUVWXYZ D:EJKMOZ
    E:CEGHRST F:IJKMOR G:ABDEFGHILMNPQRSTUWY H:KMNRTU
    I:DELMNOQRST J:EMOP K:EGHIMNPRWYZ L:ABCIKRSTUVY
    M:ACDEFGHKLMNOPQRSTUVWXYZ N:ACEFGILOPRUZ O:M P:AEFGHKLMNRSTWY
    Q:A R:EOSUW S:ABCDEGHIJKLMNORSTVXYZ T:CDFGHJKLMNORTVWZ
    U:AGMSYZ V:ACEGINU W:FS Y:ET
    Z:AMW
"""


@functools.lru_cache(maxsize=1)
def iso_country_codes() -> tuple[str, ...]:
    """ISO 3166-1 alpha-2 codes; the same on every machine."""
    return tuple(group[0] + second for group in _COUNTRY_LETTERS.split() for second in group[2:])


def category_rules(country_codes=None) -> dict[str, callable]:
    codes = list(country_codes or iso_country_codes())
    return {
        "EMAIL": lambda c: c.rlike(EMAIL_PATTERN),
        "COUNTRY": lambda c: F.upper(c).isin(*codes),
    }


def classify_columns(df: DataFrame, threshold: float = 0.8, country_codes=None) -> DataFrame:
    """``DataFrame[column, category, privacy, hit_rate]`` for string columns whose
    share of matching non-NULL values is at least ``threshold``."""
    rules = category_rules(country_codes)
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, category string, privacy string, hit_rate double")
    aggs, meta = [], []
    for c in cols:
        aggs.append(F.count(F.col(c)).alias(f"n_{len(meta)}"))
        base = len(meta)
        for cat, rule in rules.items():
            aggs.append(F.count_if(rule(F.col(c))).alias(f"h_{base}_{cat}"))
        meta.append(c)
    stats = df.agg(*aggs)
    rows = []
    for i, c in enumerate(meta):
        for cat in rules:
            rate = F.when(F.col(f"n_{i}") > 0, F.col(f"h_{i}_{cat}") / F.col(f"n_{i}"))
            rows.append(F.struct(F.lit(c).alias("column"), F.lit(cat).alias("category"),
                                 F.lit(PRIVACY_BY_CATEGORY[cat]).alias("privacy"),
                                 F.round(rate, 6).alias("hit_rate")))
    return (stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
                 .filter(F.col("hit_rate") >= threshold))


# ------------------------------------------------------------------ tags

def tag(df: DataFrame, column: str, **tags) -> DataFrame:
    """Set key/value tags on a column (kept in the field metadata)."""
    field = df.schema[column]
    meta = dict(field.metadata or {})
    meta.update({k: v for k, v in tags.items()})
    return df.withMetadata(column, meta)


def tags(df: DataFrame) -> list[tuple[str, str, str]]:
    """All (column, tag, value) triples of a DataFrame's schema."""
    return [(f.name, k, str(v)) for f in df.schema.fields for k, v in (f.metadata or {}).items()]


def tag_pii(df: DataFrame, categories: dict[str, str], pii: tuple[str, ...] = ()) -> DataFrame:
    """Tag columns with their semantic / privacy category; ``pii`` columns also
    get the masking trigger tag."""
    for c, cat in categories.items():
        extra = {PII_TAG: "Y"} if c in pii else {}
        df = tag(df, c, **{SEMANTIC_TAG: cat, PRIVACY_TAG: PRIVACY_BY_CATEGORY.get(cat, "")}, **extra)
    for c in pii:
        if c not in categories:
            df = tag(df, c, **{PII_TAG: "Y"})
    return df


# --------------------------------------------------------------- masking

def mask_value(col: Column, category: str | None, role: str, privileged=PRIVILEGED_ROLES) -> Column:
    """The policy for one value: clear for privileged roles, domain-keeping for
    EMAIL, a constant mask otherwise."""
    if role.upper() in {r.upper() for r in privileged}:
        return col
    if category == "EMAIL":
        return F.regexp_replace(col, r"^[^@]+", EMAIL_LOCAL_MASK)
    return F.lit(MASK)


def apply_masking(df: DataFrame, role: str, privileged=PRIVILEGED_ROLES) -> DataFrame:
    """Mask every column tagged ``pii = 'Y'`` for ``role``; other columns pass."""
    out = []
    for f in df.schema.fields:
        meta = f.metadata or {}
        if meta.get(PII_TAG) == "Y":
            privileged_role = role.upper() in {r.upper() for r in privileged}
            # the policy maps strings to strings: a masked non-string column becomes a string
            col = F.col(f.name) if privileged_role or isinstance(f.dataType, T.StringType) \
                else F.col(f.name).cast("string")
            masked = mask_value(col, meta.get(SEMANTIC_TAG), role, privileged)
            out.append(masked.alias(f.name, metadata=meta))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# The gold-table tagging of investor_360 / raw customers.
INVESTOR_TAGS = {"email": "EMAIL", "first_name": "NAME", "last_name": "NAME", "country": "COUNTRY"}
INVESTOR_PII = ("email", "first_name", "last_name")
