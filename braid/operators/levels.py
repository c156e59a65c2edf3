"""Validation across levels: what clips, windows and sessions refer to is looked up among the ids of their own items and of their parent.

The ids that a record refers to are held against those they may mean by hash, which leaves the different ones that mean nothing; where there are any, each
reference is looked up among these, by halving where they are many. So time grows with a record's references and ids, not with their product, and
nothing is shuffled but records and parents, once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules

#: Unknown ids up to which a reference is looked up one by one.
FEW = 16
#: Steps of halving, as powers of two from the longest array that Spark holds.
_STEPS = [1 << b for b in range(30, -1, -1)]


def _space(r: rules.Ref) -> str:
    """The column of the ids that a reference may mean."""
    return "_known_" + (f"parent_{r.parent}" if r.parent else "_".join(s for s, _ in r.sections))


def references(x: Column, r: rules.Ref) -> Column:
    """The ids that an item refers to; blank and null ones are among them."""
    many, _, one = r.field.partition("|")
    ids = F.try_variant_get(x, f"$.{many}", "array<string>") if r.many else F.array(rules.text(x, r.field))
    return F.coalesce(ids, F.array(rules.text(x, one)) if one else F.array().cast("array<string>"))


def known_ids(layer: str, v: rules.Prepared) -> dict[str, Column]:
    """By column, the ids that a record's references may mean, with blank and null, which refer to nothing by intent."""
    none = F.array(F.lit(""), F.lit(None).cast("string"))
    out = {}
    for r in rules.REFS[layer]:
        ids = [rules.texts(F.col("parent"), r.parent)] if r.parent else [rules._ids(v, *s) for s in r.sections]
        out[_space(r)] = F.concat(*ids, none)
    return out


def unknown_ids(layer: str, v: rules.Prepared) -> dict[str, Column]:
    """By column, one for each kind of reference, the ids that mean nothing: each once, in order. Needs the columns of `known_ids`."""
    out = {}
    for k, r in enumerate(rules.REFS[layer]):
        ids = F.flatten(F.transform(rules.items(v, r.section), rules._bind(references, r)))
        out[f"_unknown_{k}"] = F.sort_array(F.array_except(ids, F.col(_space(r))))
    return out


def among(values: Column, t: Column) -> Column:
    """Whether t is one of the sorted values; not true of null."""
    at = F.aggregate(F.array(*map(F.lit, _STEPS)), F.lit(0), lambda p, step: F.when(F.get(values, p + step) <= t, p + step).otherwise(p))
    return F.when(F.size(values) <= FEW, F.array_contains(values, t)).otherwise(F.get(values, at) == t)


def unknown_references(layer: str, v: rules.Prepared) -> Column:
    """An issue for each reference to nothing, repeats too. Needs the columns of `unknown_ids`."""
    parts = []
    for k, r in enumerate(rules.REFS[layer]):
        unknown = F.col(f"_unknown_{k}")

        def issues(x: Column, r: rules.Ref, unknown: Column) -> Column:
            candidate = rules.text(x, "candidate_id") if layer == "session" and r.code != "unknown_candidate_reference" else F.lit("")
            severity = F.when(candidate != "", "candidate_blocking").otherwise(r.severity)
            return F.transform(F.filter(references(x, r), lambda t: among(unknown, t)), lambda t: rules._issue(r.code, severity, F.concat(F.lit(f"{r.section}:"), t), candidate))

        found = F.flatten(F.transform(rules.items(v, r.section), rules._bind(issues, r, unknown))).cast(rules.ISSUE)
        parts.append(F.when(F.size(unknown) > 0, found).otherwise(rules._none()))
    return F.sort_array(F.concat(*parts))


def validate(layer: str, records: DataFrame, parents: DataFrame, key: str = "record_id", normalise_identity: bool = True) -> DataFrame:
    """As `rules.validate`: records (key, record VARIANT) and parents (key, parent VARIANT), keys unique in each, to key, record, parent, issues, accepted, and
    for sessions candidates. A record without a parent, and a parent without a record, is an issue."""
    p = F.col("parent")
    j, v = rules.prepared(layer, records.join(parents, key, "full_outer"))
    known, unknown = known_ids(layer, v), unknown_ids(layer, v)
    j = rules.once(rules.once(j, **known), **unknown)
    found = (
        F.when(v.v.isNull(), F.array(rules._issue("missing_model_output", "blocking")))
        .when(p.isNull(), F.array(rules._issue("missing_parent_metadata", "blocking")))
        .otherwise(F.concat(rules.record_issues(layer, v, p, normalise_identity, references=False), unknown_references(layer, v)))
    )
    return rules.finished(v, rules.once(j, issues=found).drop(*known, *unknown))
