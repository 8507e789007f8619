"""Predicates that give a verdict and a reason, the first rule that applies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.text import trimmed


def chain(rules: Sequence[tuple[str, Column]], default: str | None = None) -> Column:
    """Reason of the first condition that holds."""
    return F.coalesce(*[F.when(c, F.lit(r)) for r, c in rules], F.lit(default).cast("string"))


def name_verdict(name: Column, generic: Sequence[str], patterns: Sequence[tuple[str, str]]) -> Column:
    """null, nullify or keep, with the reason: generic names, (reason, pattern) rules, then single words without a capital
    first letter."""
    bare = trimmed(name)
    single = ~bare.rlike(r"\s") & ~bare.rlike(r"^\p{IsUppercase}")
    reason = chain([("exact_generic", F.btrim(F.lower(bare), F.lit(' "')).isin(*generic)), *[(r, bare.rlike(p)) for r, p in patterns], ("single_lowercase", single)])
    verdict = F.when(F.coalesce(bare, F.lit("")) == "", "null").when(reason.isNotNull(), "nullify").otherwise("keep")
    return F.struct(verdict.alias("verdict"), F.when(verdict == "nullify", reason).alias("reason"))


def garbage_name(name: Column, generic: Sequence[str], patterns: Sequence[tuple[str, str]]) -> Column:
    found = F.lower(F.btrim(name)).isin(*generic)
    for _, p in patterns:
        found = found | F.btrim(name).rlike(p)
    return F.coalesce(found, F.lit(False))


def license_allowed(license: Column, allowed: Sequence[str]) -> Column:
    return F.coalesce(F.exists(F.array(*[F.lit(a) for a in allowed]), lambda a: F.contains(F.lower(license), a)), F.lit(False))


def large_enough(width: Column, height: Column, least: int, longer: bool = False) -> Column:
    """Whether the shorter edge, or the longer one, has so many pixels; an image of unknown size hasn't."""
    return F.coalesce((F.greatest(width, height) if longer else F.least(width, height)) >= least, F.lit(False))


def gate(license: Column, width: Column, height: Column, mime: Column, known: Column, allowed: Sequence[str], mimes: Sequence[str], least: int = 600, longer: bool = False) -> Column:
    """ok, or what fails first: license, size (of the shorter edge, or the longer one), mime, duplicate."""
    return chain([("license", ~license_allowed(license, allowed)), ("size", ~large_enough(width, height, least, longer)), ("mime", ~mime.isin(*mimes)), ("duplicate", known)], "ok")


def terms_match(tags: Column, slug: Column, terms: Sequence[str]) -> Column:
    """No terms match all; else any term is in the tags and slug."""
    text = F.lower(F.concat_ws(" ", F.array_join(tags, " "), slug))
    return F.lit(True) if not terms else F.exists(F.array(*[F.lit(t.lower()) for t in terms]), lambda t: F.contains(text, t))


def component_gate(area: Column, box_area: Column, least: int = 1500, fill: float = 0.15) -> Column:
    return (area >= least) & (area / box_area >= fill)


def margin_gate(label: Column, margin: Column, least: float) -> Column:
    return F.when(margin >= least, label)


#: States of each classifier (fixed values): what activation may say, what of damage it may override, what damage may say.
ACTIVATIONS, SOFT, DAMAGES = ("active", "inactive"), ("intact", "stateless"), ("intact", "damaged", "destroyed")


def state_decision(damage: Column, damage_margin: Column, activation: Column, activation_margin: Column, least: float, least_activation: float) -> Column:
    """state and reason from two classifiers. Damage decides if its margin is large enough; activation only where it names
    a device's state by a large margin, larger than that of damage, and damage says nothing grave."""
    shown = lambda m: F.format_string("%.2f", m.cast("double"))
    overrides = activation.isin(*ACTIVATIONS) & (activation_margin >= least_activation) & (activation_margin > damage_margin) & damage.isin(*SOFT)
    none = F.lit(None).cast("string")
    say = lambda state, *parts: F.struct(state.alias("state"), F.concat(*parts).alias("reason"))
    margin = F.concat(F.lit(" (margin "), shown(damage_margin), F.lit(")"))
    return (
        F.when(overrides, say(activation, F.lit("activation="), activation, F.lit(" (margin "), shown(activation_margin), F.lit(", beats damage "), damage, F.lit("/"), shown(damage_margin), F.lit(")")))
        .when(damage_margin < least, say(none, F.lit("damage margin too low ("), shown(damage_margin), F.lit(")")))
        .when(damage == "stateless", say(none, F.lit("stateless object"), margin))
        .when(damage.isin(*DAMAGES), say(damage, F.lit("damage="), damage, margin))
        .otherwise(say(none, F.lit("unknown damage label '"), damage, F.lit("'")))
    )


def violations(df: DataFrame, key: Column, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """id, level, message: a row for each (level, message, condition) that a row of df breaks."""
    each = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(lv).alias("level"), F.lit(m).alias("message"))) for lv, m, c in checks]))
    return df.select(key.alias("id"), F.explode(each).alias("e")).select("id", "e.level", "e.message")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def policy_breach(rotation: Column, mirrored: Column, allowed: Column, may_mirror: Column) -> Column:
    return chain([("rotation", ~F.array_contains(allowed, rotation)), ("mirror", mirrored & ~may_mirror)])


def must(condition: Column, message: str) -> Column:
    """true, or the query fails with the message."""
    return F.when(condition, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))


def routed(subject: Column, never: Sequence[str], routes: Sequence[tuple[str, Sequence[str]]], default: str | None = None) -> Column:
    """Null if a word of `never` is in the subject; else the first route one of whose words is."""
    low = F.lower(subject)
    has = lambda ws: F.exists(F.array(*[F.lit(w) for w in ws]), lambda w: F.contains(low, w))
    return F.when(~has(never), F.coalesce(*[F.when(has(ws), F.lit(r)) for r, ws in routes], F.lit(default).cast("string"))) if never else F.coalesce(*[F.when(has(ws), F.lit(r)) for r, ws in routes], F.lit(default).cast("string"))
