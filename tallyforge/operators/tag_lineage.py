"""Tags that follow derived columns, and masks that hold on what is stored.

``governance`` tags columns; an expression loses the tag. Here the tags of every output
column are found from the lineage of its attributes in the analysed plan, whatever lies
between: aliases, expressions, joins, unions, aggregates, windows, generators. A column
that comes from a tagged one has its tags:

* through a plain rename or an expression that keeps the value's kind (``KEEPING``:
  change of case, trimming, coalesce with itself) it keeps the semantic category, so the
  mask keeps its form (an upper-cased address keeps its domain);
* through anything else it is personal (``pii`` stays) and of category ``DERIVED``: any
  part may show the value, so it is masked whole;
* an operator with code of its own (a Python function over rows) passes the tags of all
  its inputs to all its outputs.

``publish`` stores a model as a catalog table with the tags in the table's schema, and a
view per role beside it that applies the mask: whoever reads the table again finds the
tags, and readers of a view never see what their role may not.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import replace_table
from . import governance

DERIVED = "DERIVED"
# Expressions after which a value is still of its kind.
KEEPING = ("Upper", "Lower", "StringTrim", "StringTrimLeft", "StringTrimRight", "Coalesce", "Max", "Min", "First", "Last", "AnyValue",
           "AggregateExpression", "Alias", "AttributeReference")


def _seq(items) -> list:
    return [items.apply(i) for i in range(items.size())]


def _name(node) -> str:
    return node.getClass().getSimpleName()


def _id(attribute) -> int:
    return attribute.exprId().id()


def _keeps(expression) -> bool:
    return _name(expression) in KEEPING and all(_keeps(c) for c in _seq(expression.children()))


def _edges(plan, parents: dict, own: dict) -> None:
    """For every attribute: the (attribute, keeps its kind) pairs it comes from, and the
    tags that it carries itself."""
    children = _seq(plan.children())
    for child in children:
        _edges(child, parents, own)
    for a in _seq(plan.output()):
        tags = json.loads(a.metadata().json())
        if tags:
            own.setdefault(_id(a), {}).update(tags)
    known = {_id(a) for c in children for a in _seq(c.output())}
    if _name(plan) == "Union":
        for child in children:
            for a, b in zip(_seq(plan.output()), _seq(child.output())):
                if _id(a) != _id(b):
                    parents.setdefault(_id(a), set()).add((_id(b), True))
        return
    defined = set()

    def visit(expression) -> None:
        if _name(expression) == "Alias":
            defined.add(_id(expression))
            inner = expression.child()
            refs = inner.references().toSeq()
            parents.setdefault(_id(expression), set()).update((_id(r), _keeps(inner)) for r in _seq(refs))
        for c in _seq(expression.children()):
            visit(c)

    for expression in _seq(plan.expressions()):
        visit(expression)
    if _name(plan) == "Generate":
        refs = _seq(plan.generator().references().toSeq())
        for a in _seq(plan.generatorOutput()):
            defined.add(_id(a))
            parents.setdefault(_id(a), set()).update((_id(r), False) for r in refs)
    if children:                               # outputs that appear from nowhere: code of its own
        for a in _seq(plan.output()):
            if _id(a) not in known and _id(a) not in defined:
                parents.setdefault(_id(a), set()).update((k, False) for k in known)


def derived_tags(df: DataFrame) -> dict[str, dict[str, str]]:
    """The tags of each column of ``df``, its own and those of what it comes from."""
    plan = df._jdf.queryExecution().analyzed()
    parents: dict[int, set] = {}
    own: dict[int, dict] = {}
    _edges(plan, parents, own)
    found: dict[int, dict] = {}

    def tags_of(attribute: int) -> dict:
        if attribute not in found:
            found[attribute] = {}                       # a plan has no cycles; this is for repeated visits
            merged = dict(own.get(attribute, {}))
            for source, keeps in sorted(parents.get(attribute, ())):
                inherited = {k: v for k, v in tags_of(source).items() if k in (governance.PII_TAG, governance.SEMANTIC_TAG, governance.PRIVACY_TAG)}
                if inherited and not keeps:
                    inherited[governance.SEMANTIC_TAG] = DERIVED
                for k, v in inherited.items():
                    held = merged.get(k)
                    if k == governance.SEMANTIC_TAG and held not in (None, v) and k not in own.get(attribute, {}):
                        v = DERIVED                     # of two kinds at once
                    merged[k] = own.get(attribute, {}).get(k, v)
            found[attribute] = merged
        return found[attribute]

    return {name: tags_of(_id(a)) for name, a in zip(df.columns, _seq(plan.output()))}


def propagate(df: DataFrame) -> DataFrame:
    """``df`` with the derived tags in its columns' metadata."""
    for name, tags in derived_tags(df).items():
        if tags and tags != (df.schema[name].metadata or {}):
            df = df.withMetadata(name, tags)
    return df


def publish(df: DataFrame, table: str, roles: tuple[str, ...] = (), fmt: str = "parquet") -> DataFrame:
    """Store ``df`` as a catalog table with its derived tags, and a masked view
    ``<table>_for_<role>`` per role; returns the table read back."""
    stored = replace_table(propagate(df), table, fmt)
    for role in roles:
        mask_view(df.sparkSession, table, role)
    return stored


def mask_view(spark: SparkSession, table: str, role: str) -> str:
    """A persistent view of the table as ``role`` may see it, from the tags that the table keeps."""
    privileged = role.upper() in {r.upper() for r in governance.PRIVILEGED_ROLES}
    columns = []
    for f in spark.table(table).schema.fields:
        tags, name = f.metadata or {}, f"`{f.name}`"
        if tags.get(governance.PII_TAG) != "Y" or privileged:
            columns.append(name)
        elif tags.get(governance.SEMANTIC_TAG) == "EMAIL":
            columns.append(f"regexp_replace({name}, '^[^@]+', '{governance.EMAIL_LOCAL_MASK}') AS {name}")
        else:
            columns.append(f"'{governance.MASK}' AS {name}")
    view = f"{table}_for_{role}"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(columns)} FROM {table}")
    return view
