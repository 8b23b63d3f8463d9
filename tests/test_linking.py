import random
from urllib.parse import unquote

import pytest

from tripleloom.functions import terms as t
from tripleloom.operators import linking
from tripleloom.operators.joins import among, key_set
from tripleloom.sources.constants import constant_rows
from tripleloom.sources.driver_views import DriverViews

WD, DBR, FR = t.WD, t.DBR, "http://fr.dbpedia.org/resource/"
ITEM = {"item": "string", "id_property": "string", "id_value": "string", "article": "string"}
SAME = {"res": "string", "item": "string", "class": "string", "redirect_target": "string"}
KEY = dict.fromkeys(["kind", "id", "uri", "label"], "string")


def person(i, label="x"):
    return ("person", str(i), f"{t.RES}person/{i}", label)


def keys(spark, ids):
    return constant_rows(spark, KEY, [person(i) for i in ids])


def items(spark, rows):
    return constant_rows(spark, ITEM, [(WD + a, "P4985", str(i), b and t.ENWIKI + b) for a, i, b in rows])


def same(spark, rows):
    return constant_rows(spark, SAME, [(r, WD + i, c, x) for r, i, c, x in rows])


def naive_links(ids, item_rows, same_rows):
    """The rules once more, with dictionaries over the whole input."""
    found = {}
    for i in ids:
        values = {(WD + a, unquote(b) if b else None) for a, v, b in item_rows if v == i}
        if len(values) == 1:
            found[i] = values.pop()
    out = {}
    for i, (item, title) in found.items():
        expected = DBR + title if title else None
        candidates = set()
        for res, of, cls, target in same_rows:
            if WD + of != item or cls != "Person" or not res.startswith(DBR):
                continue
            if target is None:
                candidates.add(res)
            elif unquote(target) == expected:
                candidates.add(target)
        named = sorted(c for c in candidates if unquote(c) == expected)
        chosen = named[0] if named else (candidates.copy().pop() if len(candidates) == 1 else None)
        out[i] = (item, chosen)
    return {i: out.get(i, (None, None)) for i in ids}


def linked(spark, ids, item_rows, same_rows):
    rows = linking.link(keys(spark, ids), items(spark, item_rows), same(spark, same_rows)).collect()
    assert len(rows) == len(ids)
    return {int(r["id"]): (r["wikidata"], r["dbpedia"]) for r in rows}


# item, id, article | resource, item, class, redirect target
ITEMS = [
    ("Q1", 1, "One"), ("Q2a", 2, "Two"), ("Q2b", 2, "Two"), ("Q3", 3, None), ("Q4", 4, "Fo%C3%A9r"), ("Q5", 5, "Five"),
    ("Q6", 6, "Six"), ("Q7", 7, "Seven"), ("Q8", 8, "Eight"), ("Q9", 9, "Nine"), ("Q9", 9, None), ("Q10", 10, "Same"),
    ("Q10", 11, "Same"), ("Q12", 12, "Twelve"),
]
STATEMENTS = [
    (DBR + "One", "Q1", "Person", None), (DBR + "Other", "Q1", "Person", None),  # two, one by name
    (DBR + "Three_(x)", "Q3", "Person", None),  # single, no expected name
    (DBR + "Fo%C3%A9r", "Q4", "Person", None),  # by decoded name
    (DBR + "Old5", "Q5", "Person", DBR + "Five"),  # redirect to the expected name
    (DBR + "Old6", "Q6", "Person", DBR + "Elsewhere"),  # redirect elsewhere
    (DBR + "A7", "Q7", "Person", None), (DBR + "B7", "Q7", "Person", None),  # two, none by name
    (DBR + "Eight", "Q8", "Work", None), (FR + "Eight", "Q8", "Person", None),  # wrong class, wrong space
    (DBR + "Same", "Q10", "Person", None),
    (DBR + "Left", "Q12", "Person", None), (DBR + "Old12", "Q12", "Person", DBR + "Nowhere"),  # redirect dropped, one left
]


def test_every_branch(spark):
    ids = list(range(1, 14))
    got = linked(spark, ids, ITEMS, STATEMENTS)
    assert got == naive_links(ids, ITEMS, STATEMENTS)
    assert got[1][1] == DBR + "One" and got[2] == (None, None) and got[3][1] == DBR + "Three_(x)"
    assert got[4][1] == DBR + "Fo%C3%A9r" and got[5][1] == DBR + "Five" and got[6] == (WD + "Q6", None)
    assert got[7][1] is None and got[8][1] is None and got[9] == (None, None)
    assert got[10] == got[11] == (WD + "Q10", DBR + "Same") and got[12][1] == DBR + "Left" and got[13] == (None, None)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_input_against_the_plain_rules(spark, seed):
    rng = random.Random(seed)
    names = ["A", "B", "A%42", "C%43", "CC", "AB"]
    ids = list(range(30))
    item_rows = [(f"Q{rng.randrange(25)}", rng.choice(ids), rng.choice([None, *names])) for _ in range(35)]
    statements = [
        (rng.choice([DBR, DBR, FR]) + rng.choice(names), f"Q{rng.randrange(25)}", rng.choice(["Person", "Person", "Work"]),
         rng.choice([None, None, DBR + rng.choice(names)]))
        for _ in range(90)
    ]
    # one title per item, as an item has one English article
    title = {}
    item_rows = [(a, v, title.setdefault(a, b)) for a, v, b in item_rows]
    assert linked(spark, ids, item_rows, statements) == naive_links(ids, item_rows, statements)


def test_narrow_lookup_is_the_same(spark):
    some = keys(spark, [1, 2, 3, 9, 10])
    wide = linking.link_by_id(some, items(spark, ITEMS))
    narrow = linking.link_by_id(some, items(spark, ITEMS), narrow=True)
    assert sorted(map(str, wide.collect())) == sorted(map(str, narrow.collect()))


def test_key_sets_filter_or_join(spark):
    """Few keys are listed, more are joined; both give the same rows."""
    table = constant_rows(spark, {"a": "string"}, [("x",), ("y",), ("x",), (None,)])
    other = constant_rows(spark, {"b": "string", "n": "long"}, [("x", 1), ("z", 2), (None, 3), ("y", 4), ("x", 5)])
    few, many = key_set(table, "a"), key_set(table, "a", bound=1)
    assert few.values == ["x", "y"] and many.values is None
    for keys in (few, many):
        assert sorted(r["n"] for r in among(other, "b", keys).collect()) == [1, 4, 5]
    assert key_set(table.where("a = 'no'"), "a").values == []
    assert among(other, "b", key_set(table.where("a = 'no'"), "a")).count() == 0


def test_facts_of_a_key_set(spark, tiny):
    """A few subjects become a filter on the key of their names; a large set gives the same facts."""
    facts = DriverViews(spark, tiny).dbpedia
    names = ["Order_42", "Order_7", "Order_007", "Order_x", "Person_9", "Person%5F9", "Nobody"]
    table = constant_rows(spark, {"dbp": "string"}, [(DBR + n,) for n in names])
    for p in ("budget", "birthDate", "abstract"):
        few = facts.match_among(t.DBO + p, key_set(table, "dbp"))
        many = facts.match_among(t.DBO + p, key_set(table, "dbp", bound=2))
        assert sorted(map(str, few.collect())) == sorted(map(str, many.select(few.columns).collect()))
    plan = facts.match_among(t.DBO + "budget", key_set(table, "dbp"))._jdf.queryExecution().executedPlan().toString()
    assert "In(o_orderkey, [42,7])" in plan and "Join" not in plan
    assert facts.match_among(t.DBO + "budget", key_set(table.where("dbp = ''"), "dbp")).count() == 0


def test_narrow_links_with_many_keys(spark, monkeypatch):
    """Beyond the bound every lookup is a join and finds the same."""
    some = keys(spark, range(1, 13))
    few = linking.link(some, items(spark, ITEMS), same(spark, STATEMENTS), narrow=True)
    monkeypatch.setattr(linking, "key_set", lambda rows, column: key_set(rows, column, bound=1))
    many = linking.link(some, items(spark, ITEMS), same(spark, STATEMENTS), narrow=True)
    wide = linking.link(some, items(spark, ITEMS), same(spark, STATEMENTS))
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect())) == sorted(map(str, wide.collect()))


def test_candidates(spark):
    known = linking.link_by_id(keys(spark, range(1, 13)), items(spark, ITEMS))
    found = linking.link_candidates(linking.expected_names(known), same(spark, STATEMENTS)).collect()
    pairs = {(r["item"].removeprefix(WD), r["candidate"].removeprefix(DBR)) for r in found}
    assert pairs == {("Q1", "One"), ("Q1", "Other"), ("Q3", "Three_(x)"), ("Q4", "Fo%C3%A9r"), ("Q5", "Five"),
                     ("Q7", "A7"), ("Q7", "B7"), ("Q10", "Same"), ("Q12", "Left")}


def test_award_item_shared_by_two_people_keeps_the_last(spark):
    report = constant_rows(spark, dict.fromkeys(linking.REPORT.fieldNames(), "string"), [
        ("person", "p/10", "a", WD + "Q1", ""), ("person", "p/9", "b", WD + "Q1", ""), ("person", "p/1", "c", WD + "Q2", ""),
        ("movie", "m/1", "d", WD + "Q1", ""), ("person", "p/2", "e", "", ""),
    ])
    claims = constant_rows(spark, {"s": "string"}, [(WD + "Q1",), (WD + "Q9",)])
    assert [r["person"] for r in linking.award_winners(report, claims).collect()] == ["p/9"]


def test_gate_and_sample(spark):
    fields = dict.fromkeys(linking.REPORT.fieldNames(), "string")
    rows = [(k, f"{k}/{i:03}", "", WD + str(i) if i % 3 else "", "") for k in ("movie", "person") for i in range(60)]
    report = constant_rows(spark, fields, rows)
    links = constant_rows(spark, {"s": "string", "o": "string"}, [(u, w) for _, u, _, w, _ in rows if w])
    assert linking.link_gate(links, report).first()["agree"] is True
    with pytest.raises(Exception, match="not equal in number"):
        linking.link_gate(links.where("s <> 'movie/001'"), report).collect()
    assert linking.link_gate(links.where("s <> 'movie/001'"), report, fail=False).first()["agree"] is False
    sample = linking.fixed_sample(linking.linked_only(report), "kind", "uri").collect()
    again = linking.fixed_sample(linking.linked_only(report).repartition(7), "kind", "uri").collect()
    assert sorted(map(str, sample)) == sorted(map(str, again))
    assert {k: sum(r["kind"] == k for r in sample) for k in ("movie", "person")} == {"movie": 15, "person": 15}
    assert all(r["wikidata"] for r in sample)
