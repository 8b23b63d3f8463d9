"""A closure kept right while triples come and go, without closing the whole graph again.

New triples are one more round: only what has one of them among its premises is derived. For triples that go, all facts
with some derivation from them are taken out, round by round, and those that still follow from what is left are derived
again. A rule's conclusion is about a resource that one of its premises names, so only facts that name the subjects of
what was taken out can give it back.

A closure that merges names (`close(..., equal=True)`) is not kept this way: a name may be the only reason of a cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tripleloom.functions import terms as t
from tripleloom.operators.closure import PREMISES, Closure, PairRules, in_use, single_rules, singles, smallest, used_predicates
from tripleloom.operators.closure import with_superclasses
from tripleloom.operators.joins import among, key_set
from tripleloom.operators.lift import union_all
from tripleloom.operators.ontology import class_closure
from tripleloom.session import cut_lineage


@dataclass(frozen=True)
class Rules:
    single: DataFrame
    pairs: PairRules
    reach: DataFrame
    used: list[str]

    @classmethod
    def of(cls, ax: DataFrame) -> Rules:
        used = [r["p"] for r in used_predicates(ax).collect()]
        return cls(cut_lineage(single_rules(ax)), PairRules.of(ax), cut_lineage(class_closure(ax)), used)

    def read(self, triples: DataFrame) -> DataFrame:
        """The triples that rules can use, each once."""
        return cut_lineage(triples.select(t.TERM).where(F.col("p").isin(self.used)).distinct())

    def step(self, delta: DataFrame, known: DataFrame, explained: bool) -> DataFrame:
        """What follows in one step from facts of `known` with one of `delta` among them."""
        there, _ = in_use(delta)
        stated = delta.where(F.col("p") == t.TYPE).withColumns({"rule": F.lit(""), "premises": F.array().cast(PREMISES)})
        direct = union_all([singles(delta, self.single), *self.pairs.follow(delta, known, there, False), stated])
        return cut_lineage(smallest(with_superclasses(smallest(direct, explained), self.reach), explained))

    def run(self, out: Closure, delta: DataFrame, explained: bool) -> Closure:
        """Rounds from `delta` on until one adds nothing."""
        while True:
            known = facts_of(out)
            new = cut_lineage(missing(self.step(delta, known, explained), known))
            size = in_use(new)[1]
            if not size:
                return out
            out.add(new, size)
            delta = new.select(t.TERM)
            if out.bits is not None:
                # memberships of many rounds are put together
                tail = [*out.members[1:], out.bits.rows(delta)]
                out.members[1:] = tail if len(tail) < 8 else [cut_lineage(union_all(tail))]


def facts_of(found: Closure) -> DataFrame:
    return union_all([found.base.select(t.TERM), *[r.select(t.TERM) for r in found.rounds]])


def missing(facts: DataFrame, known: DataFrame) -> DataFrame:
    """Facts of a written table that are not in `known`, of which only what has their subjects is read."""
    return facts.join(among(known, "s", key_set(facts, "s")), t.TERM, "left_anti")


def present_in(facts: DataFrame, known: DataFrame) -> DataFrame:
    return facts.join(among(known, "s", key_set(facts, "s")).select(t.TERM), t.TERM, "left_semi")


def _kept(found: Closure) -> None:
    if not found.clusters.isEmpty():
        raise ValueError("a closure with merged names has to be closed again")


def extended(found: Closure, more: DataFrame, ax: DataFrame, explained: bool = False) -> Closure:
    """The closure of the same graph with the triples `more`; triples that are there already change nothing."""
    _kept(found)
    found, rules = found.settled(), Rules.of(ax)
    given = cut_lineage(missing(rules.read(more), found.base))
    # what was derived so far and is given now is no longer an added fact
    derived = cut_lineage(present_in(given, found.added()))
    rounds = found.rounds if derived.isEmpty() else [r.join(derived, t.TERM, "left_anti") for r in found.rounds]
    out = Closure(found.base.select(t.TERM).unionByName(given), [*rounds], found.clusters, [*found.sizes], [*found.held], bits=found.bits)
    delta = cut_lineage(given.join(derived, t.TERM, "left_anti"))
    if out.bits is not None:
        out.members = [*found.members, out.bits.rows(delta)]
    return out if delta.isEmpty() else rules.run(out, delta, explained)


def without(found: Closure, gone: DataFrame, ax: DataFrame, explained: bool = False) -> Closure:
    """The closure of the same graph without the triples `gone`; those that were not given change nothing."""
    _kept(found)
    found, rules = found.settled(), Rules.of(ax)
    lost = cut_lineage(present_in(rules.read(gone), found.base))
    if lost.isEmpty():
        return found
    known, added = facts_of(found), found.added().select(t.TERM)
    taken, delta = [lost], lost
    while not delta.isEmpty():
        follows = cut_lineage(rules.step(delta, known, False).select(t.TERM).join(union_all(taken), t.TERM, "left_anti"))
        delta = cut_lineage(present_in(follows, added))
        taken.append(delta)
    out_of = cut_lineage(union_all(taken))
    base = found.base.select(t.TERM).join(lost, t.TERM, "left_anti")
    rounds = [r.join(out_of, t.TERM, "left_anti") for r in found.rounds]
    out = Closure(base, rounds, found.clusters, [*found.sizes], [*found.held], bits=found.bits)
    if out.bits is not None:
        out.members = out.bits.without(found.members, out_of)
    named, left = key_set(out_of, "s"), facts_of(out)
    about = among(left, "s", named).unionByName(among(left.where(F.col("o_kind") != "lit"), "o", named))
    return rules.run(out, cut_lineage(about.distinct()), explained)
