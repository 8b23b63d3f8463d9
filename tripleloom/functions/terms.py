"""RDF terms as columns.

A triple is one row (s, p, o, o_kind, o_dt, o_lang). Nothing is NULL: an absent datatype or
language is '', so two terms are equal exactly when the four object columns are equal.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Public vocabularies and the neutral local name spaces.
RES = "http://kg.example/resource/"
ONT = "http://kg.example/ontology/"
META = "http://kg.example/metadata/"
KG_BASE = "http://kg.example/"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
FOAF = "http://xmlns.com/foaf/0.1/"
SCHEMA = "http://schema.org/"
DC = "http://purl.org/dc/elements/1.1/"
DCT = "http://purl.org/dc/terms/"
DCAT = "http://www.w3.org/ns/dcat#"
PROV = "http://www.w3.org/ns/prov#"
VOID = "http://rdfs.org/ns/void#"
DBO = "http://dbpedia.org/ontology/"
DBP = "http://dbpedia.org/property/"
DBR = "http://dbpedia.org/resource/"
WD = "http://www.wikidata.org/entity/"
WDT = "http://www.wikidata.org/prop/direct/"
ENWIKI = "https://en.wikipedia.org/wiki/"

TYPE = RDF + "type"
LABEL = RDFS + "label"
SAME_AS = OWL + "sameAs"
TITLE = DC + "title"
NAME = FOAF + "name"
DIRECTOR = DBO + "director"
STARRING = DBO + "starring"
YEAR = ONT + "releaseYear"
GENRE = ONT + "hasGenre"
STUDIO = ONT + "producedBy"
COUNTRY = ONT + "producedIn"
HAS_ROLE = ONT + "hasCastRole"
ROLE_IN = ONT + "roleInMovie"
PLAYED_BY = ONT + "playedBy"
BILLING = ONT + "billingOrder"
CHARACTER = ONT + "characterName"
HAS_AWARD = ONT + "hasAward"
MOVIE = SCHEMA + "Movie"
PERSON = FOAF + "Person"

XSD_STRING = XSD + "string"
XSD_INTEGER = XSD + "integer"
XSD_DATE = XSD + "date"
XSD_DATETIME = XSD + "dateTime"
XSD_GYEAR = XSD + "gYear"

TERM = ["s", "p", "o", "o_kind", "o_dt", "o_lang"]
OBJECT = ["o", "o_kind", "o_dt", "o_lang"]


@dataclass(frozen=True)
class Term:
    """An object term; `value` is a column in a mapping and a plain text in a pattern."""

    value: Column | str
    kind: str
    dt: str = ""
    lang: str = ""

    def columns(self) -> list[Column]:
        value = self.value if isinstance(self.value, Column) else F.lit(self.value)
        return [
            value.alias("o"),
            F.lit(self.kind).alias("o_kind"),
            F.lit(self.dt).alias("o_dt"),
            F.lit(self.lang).alias("o_lang"),
        ]


def iri(value: Column | str) -> Term:
    return Term(value, "iri")


def blank(value: Column | str) -> Term:
    return Term(value, "bnode")


def text(value: Column | str) -> Term:
    return Term(value, "lit", XSD_STRING)


def tagged(value: Column | str, lang: str) -> Term:
    return Term(value, "lit", "", lang)


def typed(value: Column | str, dt: str) -> Term:
    return Term(value.cast("string") if isinstance(value, Column) else str(value), "lit", dt)


def integer(value: Column | str | int) -> Term:
    return typed(value, XSD_INTEGER)


def mint(prefix: str, *parts: Column) -> Column:
    """IRI from a name space and columns."""
    return F.concat(F.lit(prefix), *[p.cast("string") for p in parts])


def blank_id(*parts: Column) -> Column:
    """Reproducible blank-node name: the same key gives the same node in every run."""
    return F.concat(F.lit("_:b"), F.md5(F.concat_ws("\x1f", *parts)))


def present(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit("")) != ""
