"""Rules of a closure over bits: all classes of an individual are one row, and all facts between two resources are.

What rules can make is known from the axioms, so each class and each direction of a predicate has a bit. A fact gives the
bits that follow from it alone, superclasses and inverses included; rows of one individual, or of one pair, are put together
by `bit_or` in the map tasks already. Bits that are made and not yet there are the new facts.

An IRI has neither datatype nor language, so they are not compared for memberships.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripleloom.functions import terms as t
from tripleloom.operators.lift import union_all
from tripleloom.session import cut_lineage
from tripleloom.sources.constants import constant_rows, constant_triples

#: Bits of one column of classes, and predicates whose two directions fit into one.
WORD, DIRECTIONS = 62, 31
#: More classes than this are closed fact by fact.
CLASSES = 200
PAIR = ["a", "b", "kind", "dt", "lang"]


def number(x: int) -> Column:
    return F.lit(x).cast("long")


def some(columns: list[Column]) -> Column:
    return reduce(lambda x, y: x | y, [c != 0 for c in columns])


@dataclass(frozen=True)
class Bits:
    """Classes as bits of the columns m0, m1, … beside `node`."""

    spark: SparkSession
    names: list[str]

    @property
    def words(self) -> list[str]:
        return [f"m{i}" for i in range(-(-max(len(self.names), 1) // WORD))]

    def of(self, classes) -> list[int]:
        out, place = [0] * len(self.words), {c: i for i, c in enumerate(self.names)}
        for c in classes:
            out[place[c] // WORD] |= 1 << place[c] % WORD
        return out

    def where_any(self, members: DataFrame, classes) -> DataFrame:
        return members.where(some([F.col(w).bitwiseAND(number(x)) for w, x in zip(self.words, self.of(classes))]))

    def facts(self, members: DataFrame, classes: list[str]) -> DataFrame:
        """The memberships of the classes as facts."""
        wanted = [c for c in dict.fromkeys(classes) if c in self.names]
        if not wanted:
            return constant_triples(self.spark, [])
        there = [
            F.when(reduce(lambda x, y: x | y, [F.col(w).bitwiseAND(number(x)) != 0 for w, x in zip(self.words, self.of([c])) if x]), F.lit(c))
            for c in wanted
        ]
        return self.where_any(members, wanted).select(F.col("node").alias("s"), F.explode(F.array_compact(F.array(*there))).alias("o")).select(
            "s", F.lit(t.TYPE).alias("p"), "o", F.lit("iri").alias("o_kind"), F.lit("").alias("o_dt"), F.lit("").alias("o_lang"))

    def rows(self, facts: DataFrame) -> DataFrame:
        """Memberships of these classes as bits, a row each."""
        table = constant_rows(self.spark, {"o": "string"} | dict.fromkeys(self.words, "long"), [(c, *self.of([c])) for c in self.names])
        return facts.where((F.col("p") == t.TYPE) & (F.col("o_kind") == "iri")).join(table, "o").select(F.col("s").alias("node"), *self.words)

    def without(self, tables: list[DataFrame], gone: DataFrame) -> list[DataFrame]:
        """The memberships but those among the facts `gone`."""
        taken = cut_lineage(self.put_together(self.rows(gone)).withColumnsRenamed({w: f"g{w}" for w in self.words}))
        left = [F.col(w).bitwiseAND(F.bitwise_not(F.coalesce(F.col(f"g{w}"), number(0)))).alias(w) for w in self.words]
        return [m.join(taken, "node", "left").select("node", *left) for m in tables]

    def put_together(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("node").agg(*[F.bit_or(w).alias(w) for w in rows.columns if w != "node"])


@dataclass(frozen=True)
class Told:
    """Facts but memberships as rows, and memberships as bits."""

    rows: DataFrame
    members: DataFrame
    bits: Bits

    def facts(self) -> DataFrame:
        none = F.array().cast("array<struct<s:string,p:string,o:string>>")
        both = self.rows.select(t.TERM).unionByName(self.bits.facts(self.members, self.bits.names))
        return both.withColumns({"rule": F.lit(""), "premises": none})

    def with_(self, other: Told) -> Told:
        return Told(cut_lineage(self.rows.unionByName(other.rows)), cut_lineage(self.members.unionByName(other.members)), self.bits)


@dataclass(frozen=True)
class RuleBits:
    """The rules of one premise as bits; None from `of` for axioms that these do not fit."""

    bits: Bits
    above: dict[str, set[str]]  # each class with itself
    typed: dict[str, tuple[set[str], set[str]]]  # predicate: classes of its subjects, and of its objects
    valued: dict[tuple[str, str], set[str]]  # (predicate, object): classes of its subjects
    made: list[str]  # predicates that rules make facts of
    images: dict[str, set[str]]  # predicate: those whose facts follow in the same direction
    turned: dict[str, set[str]]  # predicate: those whose facts follow in the other direction
    fixed: DataFrame  # rules whose facts have a fixed object
    fixed_rows: list

    @classmethod
    def of(cls, single: DataFrame, pairs, reach: DataFrame) -> RuleBits | None:
        rules, few = single.collect(), reach.limit(CLASSES * CLASSES + 1).collect()
        above: dict[str, set[str]] = {}
        for c, x in few:
            above.setdefault(c, set()).add(x)
        up = lambda c: above.get(c, set()) | {c}
        to_type = [r for r in rules if r["new_p"] == t.TYPE]
        fixed = [r for r in rules if r["new_p"] != t.TYPE and r["new_o"] is not None]
        inverse = [r for r in rules if r["new_p"] != t.TYPE and r["new_o"] is None]
        ends, wanted, chained = [r[0] for r in pairs.ends], [r[0] for r in pairs.some], [r[0] for r in pairs.chain]
        classes = {x for r in to_type if r["new_o"] is not None for x in up(r["new_o"])} | {x for c in above for x in up(c)}
        classes |= {x for c in [*ends, *wanted, *[r[2] for r in pairs.some], *[x for r in pairs.parts for x in r]] for x in up(c)}
        read = {p for r in pairs.chain for p in r} | {p for r in pairs.ends for p in r[1:]} | {r[1] for r in pairs.some} | {*pairs.functional}
        made = {r["new_p"] for r in [*fixed, *inverse]} | {*chained}
        fits = (
            len(few) <= CLASSES * CLASSES and len(classes) <= CLASSES and len(made) <= DIRECTIONS and t.TYPE not in read
            and all(r["new_o"] is not None and r["on_p"] != t.TYPE for r in to_type)
            and all(r["on_p"] != t.TYPE or r["on_o"] is not None and not r["turned"] for r in fixed)
            and all(r["turned"] and r["on_o"] is None and r["on_p"] != t.TYPE for r in inverse)
            and not any(c.startswith("_:") for c in classes)
        )
        if not fits:
            return None
        typed: dict[str, tuple[set[str], set[str]]] = {}
        valued: dict[tuple[str, str], set[str]] = {}
        for r in to_type:
            if r["on_o"] is not None and r["turned"]:
                return None
            of = typed.setdefault(r["on_p"], (set(), set()))[r["turned"]] if r["on_o"] is None else valued.setdefault((r["on_p"], r["on_o"]), set())
            of |= up(r["new_o"])
        images, turned = _both_ways({(r["on_p"], r["new_p"]) for r in inverse})
        bits = Bits(single.sparkSession, sorted(classes))
        table = single.where((F.col("new_p") != t.TYPE) & F.col("new_o").isNotNull())
        return cls(bits, {c: up(c) for c in classes}, typed, valued, sorted(made), images, turned, table, fixed)

    # --- memberships ------------------------------------------------------------------------------

    def can_make(self, predicates: set[str], pairs, types: bool) -> set[str]:
        """The classes that facts of the predicates can lead to, and memberships with `types`."""
        out = {c for p in predicates & {*self.typed} for side in self.typed[p] for c in side}
        out |= {c for (p, _), of in self.valued.items() if p in predicates for c in of}
        more = [c for c, *of in pairs.ends if predicates & {*of}] + [c for c, p, _ in pairs.some if types or p in predicates]
        return out | {x for c in more + [c for c, _ in pairs.parts if types] for x in self.above[c]}

    def members(self, rows: DataFrame, derived: list[DataFrame], known: list[DataFrame], can: set[str], first: bool) -> DataFrame:
        """(node, m0, …) that are new; in the first round, whose `rows` hold the given memberships too, also (a0, …), all
        that are there then. `derived` are further memberships of single classes."""
        words = self.bits.words
        sides = {f"{side}{w}": "long" for side in "soh" for w in words}
        own = lambda of, there=(): [*self.bits.of(of[0]), *self.bits.of(of[1]), *self.bits.of(there)]
        by_p = [(p, None, *own(of)) for p, of in self.typed.items()]
        by_o = [(p, o, *own((of, ()))) for (p, o), of in self.valued.items()]
        if first:  # given memberships lead to those of superclasses
            by_o += [(t.TYPE, c, *own((self.above[c] - {c}, ()), [c])) for c in self.bits.names]
        table = lambda found: constant_rows(self.bits.spark, {"on_p": "string", "on_o": "string"} | sides, found)
        open_, exact = table(by_p), table(by_o)
        found = rows.join(open_.drop("on_o"), F.col("p") == F.col("on_p"))
        valued = rows.where(F.col("o_kind") == "iri").join(exact, (F.col("p") == F.col("on_p")) & (F.col("o") == F.col("on_o")))
        zero, resource = [number(0)] * len(words), F.col("o_kind") != "lit"
        column = lambda side: [F.col(f"{side}{w}") for w in words]
        named = lambda node, made, there: F.struct(
            node.alias("node"), *[c.alias(w) for w, c in zip(words, made)], *[c.alias(f"h{w}") for w, c in zip(words, there)])
        parts = [
            found.select(F.inline(F.array(named(F.col("s"), column("s"), zero), named(F.col("o"), [F.when(resource, c) for c in column("o")], zero)))),
            valued.select(named(F.col("s"), column("s"), column("h")).alias("x")).select("x.*"),
        ]
        if derived:
            up = constant_rows(self.bits.spark, {"o": "string"} | dict.fromkeys(words, "long"), [(c, *self.bits.of(self.above[c])) for c in self.bits.names])
            given = union_all([d.select("s", "o") for d in derived]).join(up, "o")
            parts.append(given.select(named(F.col("s"), [F.col(w) for w in words], zero).alias("x")).select("x.*"))
        for table_ in known:
            held = self.bits.where_any(table_, can)
            parts.append(held.select(named(F.col("node"), zero, [F.col(w) for w in words]).alias("x")).select("x.*"))
        any_ = some([F.coalesce(F.col(c), number(0)) for w in words for c in (w, f"h{w}")])
        whole = self.bits.put_together(union_all(parts).where(any_))
        made, there = ({w: F.coalesce(F.col(f"{side}{w}"), number(0)) for w in words} for side in ("", "h"))
        new = {w: made[w].bitwiseAND(F.bitwise_not(there[w])) for w in words}
        if first:
            return whole.select("node", *[new[w].alias(w) for w in words], *[made[w].bitwiseOR(there[w]).alias(w.replace("m", "a")) for w in words])
        return whole.select("node", *[new[w].alias(w) for w in words]).where(some([F.col(w) for w in words]))

    def no_members(self) -> DataFrame:
        return constant_rows(self.bits.spark, {"node": "string"} | dict.fromkeys(self.bits.words, "long"), [])

    def all_of(self, members: DataFrame) -> DataFrame:
        """All memberships that the first round leaves."""
        return members.select("node", *[F.col(w.replace("m", "a")).alias(w) for w in self.bits.words])

    def in_use(self, members: DataFrame) -> tuple[int, set[str]]:
        """The number of new memberships, and their classes."""
        words = self.bits.words
        row = members.agg(F.sum(sum((F.bit_count(w) for w in words), F.lit(0))).alias("n"), *[F.bit_or(w).alias(w) for w in words]).first()
        return row["n"] or 0, {c for i, c in enumerate(self.bits.names) if (row[words[i // WORD]] or 0) >> i % WORD & 1}

    # --- facts between two ------------------------------------------------------------------------

    def near(self, predicates: set[str]) -> set[str]:
        """The predicates with those that follow from them alone, either way."""
        return predicates.union(*[self.images.get(p, set()) | self.turned.get(p, set()) for p in predicates])

    def unlike(self, derived: DataFrame | None, known: DataFrame, follow: bool) -> DataFrame:
        """The facts of `derived`, and what follows from them alone, that `known` has not; with `follow` also what follows
        from single facts of `known`."""
        at = {p: i for i, p in enumerate(self.made)}
        way = lambda same, other: sum(1 << at[p] for p in same) | sum(1 << at[p] + DIRECTIONS for p in other)
        table = []
        for p in sorted({*self.made, *self.images, *self.turned}):
            own, same, other = {p} & {*at}, self.images.get(p, set()), self.turned.get(p, set())
            table.append((p, way(own, ()), way((), own), way(same, other), way(other, same)))
        columns = ["own_there", "own_back", "next_there", "next_back"]
        ways = constant_rows(self.bits.spark, {"p": "string"} | dict.fromkeys(columns, "long"), table)
        resource = F.coalesce(F.col("o_kind") != "lit", F.lit(True))
        # the smaller end comes first, a missing one before all others
        back = resource & F.coalesce(F.col("s") > F.col("o"), F.col("o").isNull() & F.col("s").isNotNull())

        def rows(facts: DataFrame, made: bool) -> DataFrame:
            own, after = (F.when(back, F.col(f"{x}_back")).otherwise(F.col(f"{x}_there")) for x in ("own", "next"))
            after = F.when(resource, after).otherwise(number(0))
            of = lambda c: F.when(resource, "").otherwise(F.col(c))
            return facts.join(ways, "p").select(
                F.when(back, F.col("o")).otherwise(F.col("s")).alias("a"), F.when(back, F.col("s")).otherwise(F.col("o")).alias("b"),
                of("o_kind").alias("kind"), of("o_dt").alias("dt"), of("o_lang").alias("lang"),
                (own.bitwiseOR(after) if made else after if follow else number(0)).alias("made"), (number(0) if made else own).alias("there"),
            ).where("made <> 0 OR there <> 0")

        told = rows(known, False) if derived is None else rows(known, False).unionByName(rows(derived, True))
        whole = told.groupBy(PAIR).agg(F.bit_or("made").alias("made"), F.bit_or("there").alias("there"))
        low = number((1 << DIRECTIONS) - 1)

        def folded(c: str) -> Column:  # of a resource and itself both directions are one fact
            one = F.col(c).bitwiseAND(low).bitwiseOR(F.shiftrightunsigned(F.col(c), DIRECTIONS))
            return F.when(F.col("a").eqNullSafe(F.col("b")), one).otherwise(F.col(c))

        new = whole.select(*PAIR, folded("made").bitwiseAND(F.bitwise_not(folded("there"))).alias("new")).where("new <> 0")
        made = []
        for p, i in at.items():
            for bit, s, o in ((i, "a", "b"), (i + DIRECTIONS, "b", "a")):
                fact = F.struct(F.col(s).alias("s"), F.lit(p).alias("p"), F.col(o).alias("o"))
                made.append(F.when(F.col("new").bitwiseAND(number(1 << bit)) != 0, fact))
        facts = new.select("kind", "dt", "lang", F.explode(F.array_compact(F.array(*made))).alias("f")).select("f.*", "kind", "dt", "lang")
        kind = F.when(F.col("kind") == "lit", "lit").when(F.startswith("o", F.lit("_:")), "bnode").otherwise("iri")
        return facts.select("s", "p", "o", kind.alias("o_kind"), F.col("dt").alias("o_dt"), F.col("lang").alias("o_lang"))


def _both_ways(turns: set[tuple[str, str]]) -> tuple[dict[str, set[str]], dict[str, set[str]]]:
    """What follows from a fact by inverses alone, in its own direction and in the other one."""
    out: tuple[dict, dict] = ({}, {})
    for p in {p for p, _ in turns}:
        seen, todo = set(), [(p, 0)]
        while todo:
            q, way = todo.pop()
            for x in (n for on, n in turns if on == q):
                if (x, 1 - way) not in seen:
                    seen.add((x, 1 - way))
                    todo.append((x, 1 - way))
        for way in (0, 1):
            out[way][p] = {q for q, w in seen if w == way}
    return out
