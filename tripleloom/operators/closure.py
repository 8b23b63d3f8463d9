"""The closure of a graph under the axioms, by rounds over what the last round added.

Rules are rows of the axiom table, and a round joins facts with them. A rule of one premise reads only
the last round's facts; one of two premises joins them with all facts, from either side. What a round
adds is a written table, and it ends when a round adds nothing. Class membership is a fact of
`rdf:type` like any other, so every rule feeds every other one.

With `equal`, several values of a functional property are one individual: the smallest name of a cluster
stands for it, and facts about the others are repeated for it before the next round. With
`explained`, each added fact has its smallest derivation: a rule and the facts it was applied to. Derivations follow
from the written tables of their round, so they are looked up for the facts that are asked for, and for no others.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripleloom.functions import terms as t
from tripleloom.operators.inference import alias_clusters
from tripleloom.operators.joins import FEW, hashed_join, key_set, regroup
from tripleloom.operators.lift import MappedGraph, MergedGraph, StoredGraph, union_all
from tripleloom.operators.marks import Bits, RuleBits, Told
from tripleloom.operators.ontology import class_closure, of_kind
from tripleloom.session import cut_lineage
from tripleloom.sources.constants import constant_rows, constant_triples

#: In place of a name for the members of an unnamed "some value" class.
SOME = "_some:"
PREMISES = "array<struct<s:string,p:string,o:string>>"
NODES = {"node": "string", "cluster": "string"}


def premise(s: str = "s", p: str = "p", o: str = "o") -> Column:
    return F.struct(F.col(s).alias("s"), F.col(p).alias("p"), F.col(o).alias("o"))


def as_fact(s: Column, p: Column, o: Column, rule: Column | str, *premises: Column) -> list[Column]:
    """A derived fact about resources, with its derivation."""
    return [
        s.alias("s"), p.alias("p"), o.alias("o"),
        F.when(F.startswith(o, F.lit("_:")), "bnode").otherwise("iri").alias("o_kind"),
        F.lit("").alias("o_dt"), F.lit("").alias("o_lang"),
        (F.lit(rule) if isinstance(rule, str) else rule).alias("rule"), F.array(*premises).alias("premises"),
    ]


def single_rules(ax: DataFrame) -> DataFrame:
    """Rules of one premise: (rule, on_p, on_o, turned, new_p, new_o).

    A fact of `on_p`, with the object `on_o` unless that is null, gives a fact of `new_p` about its subject, or about its
    object where `turned`. Without `new_o` the other end of the fact is the new object.
    """
    def rows(kind: str, rule: str, on_p, on_o, turned: bool, new_p, new_o) -> DataFrame:
        as_column = lambda x: F.col(x) if isinstance(x, str) else x
        none = F.lit(None).cast("string")
        return of_kind(ax, kind).select(
            F.lit(rule).alias("rule"), as_column(on_p).alias("on_p"), (none if on_o is None else as_column(on_o)).alias("on_o"),
            F.lit(turned).alias("turned"), as_column(new_p).alias("new_p"), (none if new_o is None else as_column(new_o)).alias("new_o"),
        )

    typed = F.lit(t.TYPE)
    return union_all([
        rows("object property", "domain", "subject", None, False, typed, "property"),
        rows("datatype property", "domain", "subject", None, False, typed, "property"),
        rows("object property", "range", "subject", None, True, typed, "object"),
        rows("has value", "has value", "property", "object", False, typed, "subject"),
        rows("has value", "has value", typed, "subject", False, "property", "object"),
        rows("inverse", "inverse", "subject", None, True, "object", None),
        rows("inverse", "inverse", "object", None, True, "subject", None),
    ]).where("on_p IS NOT NULL AND new_p IS NOT NULL AND (turned OR new_o IS NOT NULL)")


def singles(delta: DataFrame, rules: DataFrame) -> DataFrame:
    """What follows from single facts of `delta`."""
    open_rules = rules.where("on_o IS NULL").drop("on_o")
    by_object = rules.where("on_o IS NOT NULL").withColumnsRenamed({"on_p": "p", "on_o": "o"})
    found = delta.join(open_rules, F.col("p") == F.col("on_p")).where(~F.col("turned") | (F.col("o_kind") != "lit"))
    exact = delta.where(F.col("o_kind") == "iri").join(by_object, ["p", "o"])
    columns = ["s", "p", "o", "rule", "turned", "new_p", "new_o"]
    both = found.select(columns).unionByName(exact.select(columns))
    other = F.when(F.col("turned"), F.col("s")).otherwise(F.col("o"))
    return both.select(as_fact(
        F.when(F.col("turned"), F.col("o")).otherwise(F.col("s")), F.col("new_p"), F.coalesce("new_o", other),
        F.col("rule"), premise(),
    ))


def with_superclasses(derived: DataFrame, reach: DataFrame) -> DataFrame:
    """`derived`, and memberships of all ancestors of the classes in it."""
    up = reach.select(F.col("class").alias("of"), "super")
    wide = derived.join(up, (F.col("p") == t.TYPE) & (F.col("o") == F.col("of")), "left")
    above = F.col("super") != F.col("o")
    return wide.select(
        "s", "p", F.coalesce("super", "o").alias("o"), "o_kind", "o_dt", "o_lang",
        F.when(above, F.lit("subclass")).otherwise(F.col("rule")).alias("rule"),
        F.when(above, F.array(premise())).otherwise(F.col("premises")).alias("premises"),
    )


@dataclass
class PairRules:
    """Rules of two premises, as rows of the axiom table: as many as the ontology has, whatever the data."""

    spark: SparkSession
    chain: list[tuple[str, str, str]]  # made, first, second
    ends: list[tuple[str, str, str]]  # class, p, q
    some: list[tuple[str, str, str]]  # class, property, wanted class
    parts: list[tuple[str, str]]  # class, one of the classes that make it up
    functional: list[str]

    @classmethod
    def of(cls, ax: DataFrame) -> PairRules:
        kinds = ("chain", "both ends", "some values", "functional", "object property")
        rows = of_kind(ax, *kinds).select("kind", "subject", "property", "object", "members").distinct().collect()
        of = {k: [r for r in rows if r["kind"] == k] for k in kinds}
        objects = {r["subject"] for r in of["object property"]}
        some = [(r["subject"], [*(r["members"] or []), SOME + r["subject"]]) for r in of["some values"]]
        return cls(
            ax.sparkSession,
            [(r["subject"], *r["members"]) for r in of["chain"] if len(r["members"]) == 2],
            [(r["subject"], *r["members"]) for r in of["both ends"]],
            [(SOME + r["subject"], r["property"], r["object"]) for r in of["some values"]],
            [(c, part) for c, parts in some for part in dict.fromkeys(parts)],
            sorted({r["subject"] for r in of["functional"]} & objects),
        )

    def table(self, rows: list[tuple], *names: str) -> DataFrame:
        return constant_rows(self.spark, dict.fromkeys(names, "string"), rows)

    def chains(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """s first x, x second o: s property o."""
        rules = self.table(self.chain, "made", "p", "second")
        start = resources(left, [r[1] for r in self.chain]).join(rules, "p").select(
            "s", F.col("o").alias("via"), "second", "made", premise().alias("one")
        )
        end = of_predicates(right, [r[2] for r in self.chain]).select(
            F.col("s").alias("via"), F.col("p").alias("second"), *t.OBJECT, premise().alias("two")
        )
        return hashed_join(start, end, ["via", "second"]).select(
            "s", F.col("made").alias("p"), *t.OBJECT, F.lit("chain").alias("rule"), F.array("one", "two").alias("premises")
        )

    def both_ends(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """m p x, m q x: x is a member."""
        rules = self.table(self.ends, "class", "p", "q")
        one = resources(left, [r[1] for r in self.ends]).join(rules, "p").select("s", "o", "class", "q", premise().alias("one"))
        two = resources(right, [r[2] for r in self.ends]).select("s", "o", F.col("p").alias("q"), premise().alias("two"))
        return hashed_join(one, two, ["s", "o", "q"]).select(
            as_fact(F.col("o"), F.lit(t.TYPE), F.col("class"), "both ends", F.col("one"), F.col("two"))
        )

    def some_values(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """s p x, x of the wanted class: s has some such value, which is a membership of its own."""
        rules = self.table(self.some, "class", "p", "wanted")
        facts = resources(left, [r[1] for r in self.some]).join(rules, "p").select(
            "s", F.col("o").alias("via"), "class", "wanted", premise().alias("one")
        )
        values = of_classes(right, [r[2] for r in self.some]).select(
            F.col("s").alias("via"), F.col("o").alias("wanted"), premise().alias("two")
        )
        return hashed_join(facts, values, ["via", "wanted"]).select(
            as_fact(F.col("s"), F.lit(t.TYPE), F.col("class"), "some values", F.col("one"), F.col("two"))
        )

    def intersections(self, delta: DataFrame, known: DataFrame) -> DataFrame:
        """Members of all listed classes, and with some wanted value, are members of the class."""
        parts = self.table(self.parts, "class", "o")
        needed = {c: sum(x == c for x, _ in self.parts) for c, _ in self.parts}
        wanted = constant_rows(self.spark, {"class": "string", "needed": "long"}, list(needed.items()))
        of_parts = [o for _, o in self.parts]
        touched = of_classes(delta, of_parts).join(parts, "o").select("s", "class").distinct()
        held = of_classes(known, of_parts).join(parts, "o").select("s", "class", premise().alias("one"))
        found = hashed_join(held, touched, ["s", "class"], "left_semi").distinct()
        whole = found.groupBy("s", "class").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("one")).alias("premises"))
        return whole.join(wanted, "class").where(F.col("n") == F.col("needed")).select(
            *as_fact(F.col("s"), F.lit(t.TYPE), F.col("class"), "intersection")[:-1], "premises"
        )

    def same(self, delta: DataFrame, known: DataFrame) -> DataFrame:
        """(s, o): values of a functional object property of one subject that `delta` says something about.

        Most subjects have one value, so facts are counted first and only those of the others are compared.
        """
        values, mine = resources(known, self.functional), F.col("p").isin(self.functional)
        told = values.select("s", "p", F.lit(1).alias("facts"), F.lit(int(delta is known)).alias("of_delta"))
        if delta is not known:
            told = told.unionByName(delta.where(mine).select("s", "p", F.lit(0).alias("facts"), F.lit(1).alias("of_delta")))
        several = told.groupBy("s", "p").agg(F.sum("facts").alias("facts"), F.max("of_delta").alias("of_delta")).where(
            (F.col("facts") > 1) & (F.col("of_delta") == 1)
        )
        # written, so that a few of them are known to be few before all facts are shuffled
        values = hashed_join(values, cut_lineage(several.select("s", "p")), ["s", "p"], "left_semi")
        # each value with the smallest one says the same as all pairs
        least = values.groupBy("s", "p").agg(F.min("o").alias("least"), F.max("o").alias("most")).where("least <> most")
        found = values.join(regroup(least.select("s", "p", "least"), ["s", "p"]), ["s", "p"]).where("o <> least")
        stated = resources(delta, [t.SAME_AS]).select("s", "o")
        return found.select(F.col("least").alias("s"), "o").unionByName(stated).distinct()

    def follow(self, delta: DataFrame | Told, known: DataFrame | Told, there: set[str], first: bool) -> list[DataFrame]:
        """What follows from `delta` with `known`, by the rules that its predicates `there` can meet."""
        return self.linked(delta, known, there, first) + self.typed(delta, known, there, first)

    def linked(self, delta: DataFrame | Told, known: DataFrame | Told, there: set[str], first: bool) -> list[DataFrame]:
        """The part of it that comes from chains."""
        out = [self.chains(delta, known)] if there & {r[1] for r in self.chain} else []
        return out + ([self.chains(known, delta)] if there & {r[2] for r in self.chain} and not first else [])

    def typed(self, delta: DataFrame | Told, known: DataFrame | Told, there: set[str], first: bool) -> list[DataFrame]:
        """The part of it that is memberships."""
        out = []
        for rule, left, right in (
            (self.both_ends, {r[1] for r in self.ends}, {r[2] for r in self.ends}),
            (self.some_values, {r[1] for r in self.some}, {t.TYPE} if self.some else set()),
        ):
            if there & left:
                out.append(rule(delta, known))
            if there & right and not first:
                out.append(rule(known, delta))
        return out + ([self.intersections(delta, known)] if t.TYPE in there and self.parts else [])


def of_predicates(facts: DataFrame | Told, predicates: list[str]) -> DataFrame:
    return (facts.rows if isinstance(facts, Told) else facts).where(F.col("p").isin(predicates))


def of_classes(facts: DataFrame | Told, classes: list[str]) -> DataFrame:
    """The memberships of the classes."""
    if isinstance(facts, Told):
        return facts.bits.facts(facts.members, classes)
    return facts.where((F.col("p") == t.TYPE) & F.col("o").isin(classes))


def resources(facts: DataFrame | Told, predicates: list[str]) -> DataFrame:
    """Facts of the predicates whose object is a resource."""
    return of_predicates(facts, predicates).where(F.col("o_kind") != "lit")


def renamed(facts: DataFrame, changed: DataFrame, clusters: DataFrame) -> DataFrame:
    """The facts that name a resource of `changed`, said of the clusters' smallest names."""
    facts = facts.where(F.col("p") != t.SAME_AS)
    names = clusters.join(changed.select("node", F.lit(True).alias("changed")), "node", "left")
    of_s, of_o = (
        names.select(F.col("node").alias(f"of_{c}"), F.col("cluster").alias(f"{c}_name"), F.col("changed").alias(f"{c}_changed"))
        for c in "so"
    )
    there = (F.col("o") == F.col("of_o")) & (F.col("o_kind") != "lit")
    rows = facts.join(of_s, F.col("s") == F.col("of_s"), "left").join(of_o, there, "left")
    return rows.where("s_changed OR o_changed").select(
        F.coalesce("s_name", "s").alias("s"), "p", F.coalesce("o_name", "o").alias("o"), "o_kind", "o_dt", "o_lang",
        F.lit("same individual").alias("rule"), F.array(premise()).alias("premises"),
    )


@dataclass
class Closure:
    """Given facts that rules can use, what each round added, and (node, cluster) of individuals with several names."""

    base: DataFrame
    rounds: list[DataFrame]
    clusters: DataFrame
    #: Facts added in each round. The tables of `rounds` are fewer: small ones are joined as they become many.
    sizes: list[int] = field(default_factory=list)
    held: list[int] = field(default_factory=list)
    #: With `explained`, whatever each round derived, in all ways it did: computed from the written tables when it is read.
    ways: list[DataFrame] = field(default_factory=list)
    #: Where rounds went over bits: (other facts, memberships) that each table of `rounds` shows as facts.
    parts: list[Told] = field(default_factory=list)
    #: All memberships that rules can make, given ones as well, each once in one of these tables of `bits`.
    members: list[DataFrame] = field(default_factory=list)
    bits: Bits | None = None
    #: The given facts said of the smallest names, where names were merged before the rounds.
    named: DataFrame | None = None

    def add(self, new: DataFrame | Told, size: int) -> None:
        """One more round. A table is written again with the next one once it is not larger than that, so seldom."""
        self.sizes.append(size)
        self.held.append(size)
        if isinstance(new, Told):
            self.parts.append(new)
        self.rounds.append(new.facts() if isinstance(new, Told) else new)
        while len(self.held) > 3 and self.held[-2] <= 2 * self.held[-1]:
            if self.parts:
                self.parts[-2:] = [self.parts[-2].with_(self.parts[-1])]
                self.rounds[-2:] = [self.parts[-1].facts()]
            else:
                self.rounds[-2:] = [cut_lineage(self.rounds[-2].unionByName(self.rounds[-1]))]
            self.held[-2:] = [sum(self.held[-2:])]

    def added(self) -> DataFrame:
        """The added facts, with their derivations where they are explained."""
        columns = [*t.TERM, "rule", "premises"]
        if self.ways and self.rounds:
            told = hashed_join(self.new_terms(), self.smallest_ways(self.new_terms(), self.ways), t.TERM, "left")
            none = {"rule": F.coalesce("rule", F.lit("")), "premises": F.coalesce("premises", F.array().cast(PREMISES))}
            return told.withColumns(none).select(columns)
        empty = self.base.limit(0).withColumn("rule", F.lit("")).withColumn("premises", F.array().cast(PREMISES))
        return union_all([r.select(columns) for r in [empty, *self.rounds, *self.of_names()]])

    def new_terms(self) -> DataFrame:
        """The added facts alone."""
        return union_all([r.select(t.TERM) for r in [self.base.limit(0), *self.rounds, *self.of_names()]])

    def of_names(self) -> list[DataFrame]:
        """What was given of other names is added for the smallest ones."""
        return [] if self.named is None else [unseen(self.named, self.base, False)]

    def settled(self) -> Closure:
        """The same closure with its derivations written."""
        return replace(self, rounds=[cut_lineage(self.added())], held=[sum(self.held)], ways=[]) if self.ways else self

    @staticmethod
    def smallest_ways(terms: DataFrame, ways: list[DataFrame]) -> DataFrame:
        """For each of `terms`, which are added facts, its smallest derivation in the first round that derived it.

        The rows of a fact meet by a hash that the aggregation is led by as well, so that they are sorted once.
        """
        told = union_all([
            w.select(*t.TERM, F.struct(F.lit(i).alias("round"), "rule", "premises").alias("why")) for i, w in enumerate(ways)
        ])
        keys, mark = ["_hash", *t.TERM], F.xxhash64(*t.TERM).alias("_hash")
        met = told.select(mark, *told.columns).join(terms.select(mark, *t.TERM), keys)
        return met.groupBy(keys).agg(F.min("why").alias("why")).select(*t.TERM, "why.rule", "why.premises")

    def derivations(self, asked: DataFrame) -> DataFrame | None:
        """(s, p, o, premises) of the added ones among the facts `asked`, None if there are none."""
        key = ["s", "p", "o"]
        if not self.ways:
            return self.added().select(*key, "premises")
        # few predicates or objects become filters that reach the scans and keep other derivations out of the shuffle
        few = [k for k in (key_set(asked, "p"), key_set(asked, "o")) if k.values is not None]

        def near(rows: DataFrame) -> DataFrame:
            for k in few:
                rows = rows.where(F.col(k.column).isin(k.values))
            return rows

        terms = cut_lineage(hashed_join(near(self.new_terms()), asked.select(key).distinct(), key, "left_semi"))
        if terms.isEmpty():
            return None
        return self.smallest_ways(terms, [near(w) for w in self.ways]).select(*key, "premises")

    def _of_names(self, facts: DataFrame) -> DataFrame:
        other = self.clusters.where("node <> cluster").select("node")
        kept = facts.join(other, F.col("s") == F.col("node"), "left_anti")
        return kept.join(other, (F.col("o") == F.col("node")) & (F.col("o_kind") != "lit"), "left_anti")

    def types(self) -> DataFrame:
        """(s, class) of every individual by its smallest name."""
        if self.bits is not None:
            # those that rules can make are told apart already, so only others are made distinct
            made = [self.bits.facts(m, [c for c in self.bits.names if not c.startswith(SOME)]) for m in self.members]
            other = memberships(self.base if self.named is None else self.named).where(~F.col("o").isin(self.bits.names))
            return union_all([m.select("s", F.col("o").alias("class")) for m in made] + [other.select("s", F.col("o").alias("class")).distinct()])
        rows = memberships(union_all([self.base.select(t.TERM), self.new_terms()]))
        return self._of_names(rows).select("s", F.col("o").alias("class")).distinct()

    def facts(self) -> DataFrame:
        """The added facts but memberships, by smallest names."""
        return self._of_names(self.new_terms().where(F.col("p") != t.TYPE))

    def explain(self, facts: DataFrame) -> DataFrame:
        """(of, s, p, o): the given triples that each fact (of, s, p, o) rests on.

        Goes from facts to the premises of their derivations, which were there before them: in an earlier round, or
        as the class from which an ancestor follows. So it ends after two steps a round at most.
        """
        key = ["s", "p", "o"]
        asked, given = cut_lineage(facts.select("of", *key).distinct()), []
        while True:
            derived = self.derivations(asked)
            if derived is None:
                return union_all([*given, asked]).distinct()
            found = cut_lineage(hashed_join(asked, derived, key, "left"))
            given.append(found.where("premises IS NULL").select("of", *key))
            asked = cut_lineage(
                found.where("premises IS NOT NULL").select("of", F.explode("premises").alias("one")).select("of", "one.*").distinct()
            )
            if asked.isEmpty():
                return union_all(given).distinct()


def memberships(facts: DataFrame) -> DataFrame:
    return facts.where((F.col("p") == t.TYPE) & (F.col("o_kind") == "iri") & ~F.startswith("o", F.lit(SOME)))


def as_bag(graph) -> DataFrame:
    """All triples, some perhaps repeated: no shuffle makes them a set."""
    if isinstance(graph, MergedGraph):
        return union_all([as_bag(g) for g in graph.graphs])
    if isinstance(graph, MappedGraph):
        return union_all([m.triples().select(t.TERM) for m in graph.maps])
    return graph.triples().select(t.TERM)


def used_predicates(ax: DataFrame) -> DataFrame:
    """(p): predicates that a rule reads."""
    listed = of_kind(ax, "object property", "datatype property", "has value", "some values", "inverse", "chain", "both ends", "functional")
    one = listed.select(F.explode(F.concat(
        F.array(F.when(F.col("kind").isin("has value", "some values"), F.col("property")).otherwise(F.col("subject"))),
        F.when(F.col("kind") == "inverse", F.array("object")).otherwise(F.array().cast("array<string>")),
        F.when(F.col("kind").isin("chain", "both ends"), F.col("members")).otherwise(F.array().cast("array<string>")),
    )).alias("p"))
    built_in = constant_rows(ax.sparkSession, {"p": "string"}, [(t.TYPE,), (t.SAME_AS,)])
    return one.where("p IS NOT NULL").unionByName(built_in).distinct()


def close(graph, ax: DataFrame, equal: bool = False, explained: bool = False) -> Closure:
    """The closure of `graph`: see the module's text."""
    single, pairs = cut_lineage(single_rules(ax)), PairRules.of(ax)
    reach = class_closure(ax)
    used = as_bag(graph).where(F.col("p").isin([r["p"] for r in used_predicates(ax).collect()]))
    # a stored graph is read where it is; of others the facts are computed once
    base = used if isinstance(graph, StoredGraph) else cut_lineage(used)
    out = Closure(base, [], constant_rows(ax.sparkSession, NODES, []))
    rules = None if explained else RuleBits.of(single, pairs, reach)
    if rules is not None:
        return merged(out, pairs, rules) if equal else marked(out, pairs, rules)
    links = constant_rows(ax.sparkSession, {"s": "string", "o": "string"}, [])
    of_single = {tuple(r) for r in single.select("on_p", "new_p", "new_o").collect()}
    delta, first = base, True
    there, _ = in_use(base)
    while True:
        known = union_all([base, *[r.select(t.TERM) for r in out.rounds]])
        direct = union_all([singles(delta, single), *pairs.follow(delta, known, there, first)])
        if first:  # later ones are given their superclasses as they are derived
            stated = base.where(F.col("p") == t.TYPE)
            direct = direct.unionByName(stated.withColumns({"rule": F.lit(""), "premises": F.array().cast(PREMISES)}))
        derived = with_superclasses(direct, reach)
        # what the predicates of the last round can lead to; renaming gives facts of every predicate
        old = known if equal else known.where(comparable(of_single, pairs, reach, there, first))
        if equal:
            links, derived = _with_names(out, links, delta, known, derived, pairs, there)
        new = cut_lineage(unseen(derived, old, False))
        there, size = in_use(new)
        if not size:
            return out
        out.add(new, size)
        if explained:
            out.ways.append(derived)
        delta, first = new.select(t.TERM), False


def marked(out: Closure, pairs: PairRules, rules: RuleBits) -> Closure:
    """The rounds over bits. A round completes the facts but memberships first, and then looks for memberships, so that
    most of either are made in the first one."""
    given, bits = out.base if out.named is None else out.named, rules.bits
    known, delta, first = given, given, True
    there, classes = in_use(given)[0], set()
    while True:
        more, added, n_rows = linked_facts(pairs, rules, delta, known, there if first else set(), classes, first)
        known = known.unionByName(more) if n_rows else known
        wanted = {r[2] for r in pairs.some} | {c for _, c in pairs.parts}
        reads = added | (there if first else {t.TYPE} & ({t.TYPE} if classes & wanted else set()))
        now, whole = (known, known) if first else (Told(more, delta.members, bits), Told(known, union_all(out.members), bits))
        can = {*bits.names} if first else rules.can_make(added, pairs, t.TYPE in reads)
        members, n_members, classes = rules.no_members(), 0, set()
        if can:
            members = cut_lineage(rules.members(known if first else more, pairs.typed(now, whole, reads, first), out.members, can, first))
            n_members, classes = rules.in_use(members)
        if first:
            out.members, out.bits = [rules.all_of(members)], bits
            members = members.select("node", *bits.words)
        elif n_members:
            out.members.append(members)
        if not n_rows + n_members:
            return out
        delta = Told(more, members, bits)
        out.add(delta, n_rows + n_members)
        if len(out.parts) < len(out.members):  # tables of rounds were joined
            out.members[1:] = [part.members for part in out.parts[1:]]
        # tables that were joined since are read where they are now
        known, first = union_all([given, *[part.rows for part in out.parts]]), False


def linked_facts(
    pairs: PairRules, rules: RuleBits, delta: DataFrame | Told, known: DataFrame, there: set[str], classes: set[str], first: bool
) -> tuple[DataFrame, set[str], int]:
    """The facts but memberships that follow from `delta` with `known`, until no more do: a written table, their predicates
    and number. Those that `delta` has were followed already, but for the first round."""
    steps, added, n, said, fresh = [], set(), 0, there, delta
    if first and rules.turned:
        steps = [cut_lineage(rules.unlike(None, known, True))]
        added, n = in_use(steps[0])
        said, fresh = there | added, known.unionByName(steps[0])
    while True:
        known_now = union_all([known, *steps])
        links = [d.select(t.TERM) for d in pairs.linked(fresh, known_now, said, first)]
        fixed = [r for r in rules.fixed_rows if r["on_p"] in said and (first or r["on_p"] != t.TYPE) or r["on_p"] == t.TYPE and r["on_o"] in classes]
        if fixed:
            of_type, others = [r["on_o"] for r in fixed if r["on_p"] == t.TYPE], [r["on_p"] for r in fixed if r["on_p"] != t.TYPE]
            links.append(singles(of_classes(fresh, of_type).unionByName(of_predicates(fresh, others)), rules.fixed).select(t.TERM))
        if not links:
            break
        near = F.col("p").isin(sorted(rules.near({r[0] for r in pairs.chain})) if len(links) > bool(fixed) else [])
        for r in fixed:  # a fixed object that no other fact follows from reaches the scan
            alone = not r["turned"] and rules.near({r["new_p"]}) == {r["new_p"]}
            near = near | ((F.col("p") == r["new_p"]) & (F.col("o") == r["new_o"]) if alone else F.col("p").isin(sorted(rules.near({r["new_p"]}))))
        new = cut_lineage(rules.unlike(union_all(links), known_now.where(near), False))
        said, size = in_use(new)
        if not size:
            break
        steps.append(new)
        added, n, fresh, classes, first = added | said, n + size, new, set(), False
    if not n:
        return constant_triples(rules.bits.spark, []), added, 0
    return steps[0] if len(steps) == 1 else cut_lineage(union_all(steps)), added, n


def merged(out: Closure, pairs: PairRules, rules: RuleBits) -> Closure:
    """The closure where several values of a functional property are one individual: the given facts are said of the
    smallest names before they are closed, and again if what the closure adds merges more names."""
    facts, whole, new = out.base, out.base, out.base
    links = constant_rows(rules.bits.spark, {"s": "string", "o": "string"}, [])
    while True:
        found = cut_lineage(pairs.same(new, whole))
        if not found.isEmpty():
            links = cut_lineage(links.unionByName(found).distinct())
            out.clusters = cut_lineage(alias_clusters(links))
            facts = whole = new = cut_lineage(said_of_names(whole, out.clusters))
            out.named = facts
            continue
        if new is not facts:
            return out
        marked(out, pairs, rules)
        # a round adds few predicates that names depend on
        tables = [part.rows.where(F.col("p").isin([*pairs.functional, t.SAME_AS])) for part in out.parts]
        if not tables or all(x.isEmpty() for x in tables):
            return out
        new, whole = union_all(tables), union_all([facts, *[part.rows for part in out.parts]])
        if cut_lineage(pairs.same(new, whole)).isEmpty():
            return out
        out.rounds, out.sizes, out.held, out.parts, out.members = [], [], [], [], []


def said_of_names(facts: DataFrame, clusters: DataFrame) -> DataFrame:
    """All facts, of the clusters' smallest names."""
    names = clusters.where("node <> cluster")
    of_s, of_o = (names.select(F.col("node").alias(f"of_{c}"), F.col("cluster").alias(f"{c}_name")) for c in "so")
    there = (F.col("o") == F.col("of_o")) & (F.col("o_kind") != "lit")
    rows = facts.where(F.col("p") != t.SAME_AS).join(of_s, F.col("s") == F.col("of_s"), "left").join(of_o, there, "left")
    return rows.select(F.coalesce("s_name", "s").alias("s"), "p", F.coalesce("o_name", "o").alias("o"), "o_kind", "o_dt", "o_lang")


def comparable(of_single: set[tuple], pairs: PairRules, reach: DataFrame, there: set[str], first: bool) -> Column:
    """Which facts a round can derive from facts of the predicates `there`, by predicate and by object where rules name
    it. Only known facts among them can be derived again."""
    made = {(p, o) for on, p, o in of_single if on in there} | {(r[0], None) for r in pairs.chain if there & {*r[1:]}}
    made |= {(t.TYPE, None)} if first else set()  # stated memberships are given their superclasses
    made |= {(t.TYPE, c) for c, *of in pairs.ends if there & {*of}}
    made |= {(t.TYPE, c) for c, p, _ in pairs.some if there & {p, t.TYPE}} | {(t.TYPE, c) for c, _ in pairs.parts if t.TYPE in there}
    objects: dict[str, set] = {}
    for p, o in made:
        objects.setdefault(p, set()).add(o)
    classes = objects.get(t.TYPE, {None})
    if None not in classes:
        above = key_set(reach.where(F.col("class").isin(sorted(classes))), "super").values
        objects[t.TYPE] = {None} if above is None else classes | {*above}
    out = F.lit(False)
    for p in sorted(objects):
        whole = None in objects[p] or len(objects[p]) > FEW
        out = out | (F.col("p") == p if whole else (F.col("p") == p) & F.col("o").isin(sorted(objects[p])))
    return out


def in_use(facts: DataFrame) -> tuple[set[str], int]:
    """The predicates of some facts, and their number."""
    row = facts.agg(F.collect_set("p"), F.count("*")).first()
    return set(row[0]), row[1]


def smallest(derived: DataFrame, explained: bool) -> DataFrame:
    """Each fact once, with its smallest derivation where facts are explained."""
    if explained:
        return derived.groupBy(t.TERM).agg(F.min(F.struct("rule", "premises")).alias("why")).select(*t.TERM, "why.*")
    none = F.array().cast(PREMISES)
    return derived.select(t.TERM).distinct().withColumns({"rule": F.lit(""), "premises": none})


def unseen(derived: DataFrame, old: DataFrame, explained: bool) -> DataFrame:
    """The facts of `derived` that `old` has not, each once; one with a null is in no other's place, as in a join.

    Both meet in one aggregation by hash, which needs no sort by names that begin alike.
    """
    if explained:
        return hashed_join(smallest(derived, True), old.select(t.TERM), t.TERM, "left_anti")
    sides = derived.select(*t.TERM, F.lit(1).alias("_side")).unionByName(
        old.select(*t.TERM, F.lit(2).alias("_side")).dropna(subset=t.TERM)
    )
    new = sides.groupBy(t.TERM).agg(F.bit_or("_side").alias("_side")).where(F.col("_side") == 1)
    return new.select(*t.TERM, F.lit("").alias("rule"), F.array().cast(PREMISES).alias("premises"))


def _with_names(
    out: Closure, links: DataFrame, delta: DataFrame, known: DataFrame, derived: DataFrame, pairs: PairRules, there: set[str]
) -> tuple[DataFrame, DataFrame]:
    """All links so far, and `derived` said of the smallest names too; updates the clusters of `out`.

    Facts about a resource whose name has changed are repeated for the new name.
    """
    columns = [*t.TERM, "rule", "premises"]
    more, before = [derived.select(columns)], out.clusters
    if there & {*pairs.functional, t.SAME_AS}:
        found = cut_lineage(pairs.same(delta, known))
        if not found.isEmpty():
            links = cut_lineage(links.unionByName(found).distinct())
            out.clusters = cut_lineage(alias_clusters(links))
            changed = out.clusters.where("node <> cluster").join(before, ["node", "cluster"], "left_anti")
            more.append(renamed(known, cut_lineage(changed), out.clusters).select(columns))
    others = out.clusters.where("node <> cluster")
    more.append(renamed(derived.select(t.TERM), others, out.clusters).select(columns))
    return links, union_all(more)


def materialise(graph, ax: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Types and all added property facts at the fixpoint, as (types, facts)."""
    found = close(graph, ax)
    return found.types(), found.facts()
