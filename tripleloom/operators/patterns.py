"""Graph patterns as filters and joins.

A pattern is (subject, predicate, object). A text that starts with '?' is a variable, any other
text is an IRI, and a `Term` is a literal or IRI constant. A variable that stands in a subject or
predicate position somewhere can only be an IRI or a blank node and is one column. Any other
variable `?v` is the column `v` with its kind, datatype and language beside it in `v__kind`,
`v__dt` and `v__lang`; when two patterns share it, all four must be equal. Where one side of a join has
it as a resource only, the other side's term has to be a resource as well.

A variable that OPTIONAL left unbound (NULL) meets nothing in a later group, other than in SPARQL, where
it would meet everything; bind such groups first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tripleloom.functions import terms as t
from tripleloom.operators.lift import MappedGraph, Rule, TripleMap, as_set, union_all

Pattern = tuple[str, str, "str | t.Term"]
PARTS = {"o": "", "o_kind": "__kind", "o_dt": "__dt", "o_lang": "__lang"}


def is_variable(x) -> bool:
    return isinstance(x, str) and x.startswith("?")


def resource_variables(patterns: list[Pattern]) -> set[str]:
    return {x for s, p, _ in patterns for x in (s, p) if is_variable(x)}


def scan(graph, pattern: Pattern, resources: set[str]) -> DataFrame:
    """Solutions of one pattern as a filter and projection of the triples."""
    s, p, o = pattern
    one = None if is_variable(s) else s
    rows = graph.match(None if is_variable(p) else p, subject=one) if one or not is_variable(p) else graph.triples()
    out: dict[str, Column] = {}
    conditions: list[Column] = []

    def bind(variable: str, columns: dict[str, Column]) -> None:
        for name, column in columns.items():
            if name in out:
                conditions.append(out[name] == column)
            else:
                out[name] = column

    if is_variable(s):
        bind(s, {s[1:]: F.col("s")})
    else:
        conditions.append(F.col("s") == s)
    if is_variable(p):
        bind(p, {p[1:]: F.col("p")})
    if is_variable(o):
        if o in resources:
            conditions.append(F.col("o_kind") != "lit")
            bind(o, {o[1:]: F.col("o")})
        else:
            bind(o, {o[1:] + end: F.col(c) for c, end in PARTS.items()})
    else:
        term = o if isinstance(o, t.Term) else t.iri(o)
        wanted = dict(zip(t.OBJECT, (term.value, term.kind, term.dt, term.lang)))
        conditions += [F.col(c) == v for c, v in wanted.items()]
    for condition in conditions:
        rows = rows.where(condition)
    return rows.select(*[c.alias(n) for n, c in out.items()])


def _answer(graph: MappedGraph, pattern: Pattern) -> tuple[TripleMap, Rule] | None:
    """The one rule that alone can answer a pattern, if its map has one row at most for each subject.

    Other rules of the predicate do not count where their object is another constant.
    """
    s, p, o = pattern
    if not is_variable(s) or is_variable(p):
        return None
    wanted = None if is_variable(o) else o if isinstance(o, t.Term) else t.iri(o)

    def possible(made: t.Term) -> bool:
        if wanted is None:
            return True
        same = (made.kind, made.dt, made.lang) == (wanted.kind, wanted.dt, wanted.lang)
        return same and (isinstance(made.value, Column) or made.value == wanted.value)

    found = [(m, r) for m in graph.maps for r in m.rules if r.p == p and possible(r.o)]
    return found[0] if len(found) == 1 and found[0][1].of in found[0][0].single else None


def stars(graph, patterns: list[Pattern]) -> tuple[list[list[tuple[Pattern, TripleMap, Rule]]], list[Pattern]]:
    """Groups of patterns about one subject that one row answers together, and the patterns left over."""
    groups: dict[tuple, list[tuple[Pattern, TripleMap, Rule]]] = {}
    rest = []
    for pattern in patterns:
        answer = _answer(graph, pattern) if isinstance(graph, MappedGraph) else None
        if answer is None:
            rest.append(pattern)
        else:
            groups.setdefault((pattern[0], id(answer[0]), answer[1].of), []).append((pattern, *answer))
    rest += [g[0][0] for g in groups.values() if len(g) == 1]
    return [g for g in groups.values() if len(g) > 1], [p for p in patterns if p in rest]


def scan_star(star: list[tuple[Pattern, TripleMap, Rule]], resources: set[str]) -> DataFrame:
    """Solutions of patterns about one subject as a projection of the rows they are mapped from, without a join."""
    subject, rows = star[0][0][0], star[0][1].rows
    out: dict[str, Column] = {subject[1:]: star[0][2].s}
    conditions: list[Column] = [r.when for _, _, r in star if r.when is not None]
    for (_, _, o), _, rule in star:
        made = dict(zip(t.OBJECT, rule.o.columns()))
        if is_variable(o) and o in resources:
            columns = {o[1:]: made["o"]}
            conditions += [] if rule.o.kind != "lit" else [F.lit(False)]
        elif is_variable(o):
            columns = {o[1:] + end: made[c] for c, end in PARTS.items()}
        else:
            term = o if isinstance(o, t.Term) else t.iri(o)
            columns = {}
            conditions.append(made["o"] == term.value)
        for name, column in columns.items():
            if name in out:
                conditions.append(out[name] == column)
            else:
                out[name] = column
    for condition in [*conditions, star[0][2].s.isNotNull()]:
        rows = rows.where(condition)
    return rows.select(*[c.alias(n) for n, c in out.items()])


def bgp(graph, patterns: list[Pattern], resources: set[str] | None = None) -> DataFrame:
    """All solutions of a conjunction of patterns (a bag of bindings).

    Patterns about one subject whose triples come from the same row (`stars`) are one projection of the rows; the
    others are a scan each. `resources` names further variables known to hold IRIs, e.g. those of an outer pattern. A pattern of
    constants only is a condition: without its triple there is no solution.
    """
    known = resource_variables(patterns) | (resources or set())
    together, alone = stars(graph, patterns)
    scans = [(patterns.index(g[0][0]), scan_star(g, known)) for g in together]
    scans += [(patterns.index(p), scan(graph, p, known)) for p in alone]
    todo = [rows for _, rows in sorted(scans, key=lambda x: x[0])]
    conditions = [d.limit(1).select(F.lit(True).alias("_found")) for d in todo if not d.columns]
    todo = [d for d in todo if d.columns]
    if not todo:
        result, conditions = conditions[0], conditions[1:]
    else:
        result = todo.pop(0)
    while todo:
        at = next((i for i, d in enumerate(todo) if set(d.columns) & set(result.columns)), None)
        if at is None:
            raise ValueError("the patterns share no variable; join the parts explicitly")
        result = _joined(result, todo.pop(at), "inner")
    for condition in conditions:
        result = result.join(condition.select(F.col("_found").alias("_also")), F.col("_also"), "left_semi")
    return result


def _terms(columns: list[str]) -> set[str]:
    """Variables that have their kind beside them."""
    return {c for c in columns if c + PARTS["o_kind"] in columns}


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the shared variables. A variable that is a whole term on one side and a resource on the other
    is equal where the term is a resource of that name."""
    left_terms, right_terms = _terms(left.columns), _terms(right.columns)
    keys = [c for c in right.columns if c in left.columns]
    for term in (right_terms - left_terms) & set(keys):
        right = right.where(F.col(term + PARTS["o_kind"]) != "lit").drop(*[term + e for e in PARTS.values() if e])
    half = sorted((left_terms - right_terms) & set(keys))
    if not keys:
        # no shared variable: the groups meet as wholes, so that only their being empty or not matters
        if how in ("left_semi", "left_anti"):
            return left.join(right.limit(1).select(F.lit(True).alias("_also")), F.col("_also"), how)
        raise ValueError("the groups share no variable; join the parts explicitly")
    if not half:
        return left.join(right, keys, how)
    marked = right.select(*[F.col(c).alias("_r_" + c) if c in keys else F.col(c) for c in right.columns])
    equal = [F.col(c) == F.col("_r_" + c) for c in keys] + [F.col(c + PARTS["o_kind"]) != "lit" for c in half]
    met = left.join(marked, equal, how)
    return met.drop(*["_r_" + c for c in keys])


def optional(left: DataFrame, right: DataFrame) -> DataFrame:
    """OPTIONAL: left outer join on the shared variables. A filter of the optional group belongs
    on `right` before the call. A group without a shared variable is an error."""
    return _joined(left, right, "left")


def exists(left: DataFrame, right: DataFrame) -> DataFrame:
    """Solutions with a partner; without a shared variable all of them if there is any on the right."""
    return _joined(left, right, "left_semi")


def not_exists(left: DataFrame, right: DataFrame) -> DataFrame:
    return _joined(left, right, "left_anti")


def alternative(left: DataFrame, right: DataFrame) -> DataFrame:
    """UNION: bag union; variables of one side only are unbound on the other."""
    return left.unionByName(right, allowMissingColumns=True)


def ask(solutions: DataFrame) -> DataFrame:
    return solutions.limit(1).agg((F.count(F.lit(1)) > 0).alias("answer"))


def construct(solutions: DataFrame, template: list[tuple[Column, Column | str, t.Term]]) -> DataFrame:
    """CONSTRUCT: the template per solution; triples with an unbound part are left out."""
    made = []
    for s, p, o in template:
        p = p if isinstance(p, Column) else F.lit(p)
        full = s.isNotNull() & p.isNotNull() & o.columns()[0].isNotNull()
        made.append(F.when(full, F.struct(s.alias("s"), p.alias("p"), *o.columns())))
    return as_set(solutions.select(F.inline(F.array(*made))).where(F.col("s").isNotNull()))


def describe(graph, resource: str) -> DataFrame:
    """DESCRIBE: the triples of a resource and of the blank nodes it points to."""
    own = graph.match(None, subject=resource).select(*t.TERM)
    nodes = own.where(F.col("o_kind") == "bnode").select(F.col("o").alias("s")).distinct()
    if not has_blank_subjects(graph):
        return as_set(own)
    return as_set(union_all([own, graph.triples().join(nodes, "s", "left_semi").select(*t.TERM)]))


def has_blank_subjects(graph) -> bool:
    """Whether a subject can be a blank node: not where every rule mints its subjects in a name space."""
    return not isinstance(graph, MappedGraph) or any(
        r.of is None or r.of[0].startswith("_:") for m in graph.maps for r in m.rules
    )
