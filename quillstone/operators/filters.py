"""Filters of the catalogue and rules of the triage, given as data and compiled to one column expression."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.operators import relational as R


UNSORTED = "Nezařazeno"  # fixed value: the type of documents without one


@dataclass(frozen=True)
class Synonym:
    """Words that stand for more: an alias in a query adds search terms, and documents by designation."""

    aliases: tuple[str, ...]
    terms: tuple[str, ...] = ()
    designations: tuple[str, ...] = ()

    def triggered(self, query: str) -> bool:
        """An alias occurs in the query as whole words, case and blanks aside."""
        q = " ".join(query.casefold().split())
        return any(re.search(rf"(?<!\w){re.escape(' '.join(a.casefold().split()))}(?!\w)", q) for a in self.aliases)


@dataclass(frozen=True)
class Filter:
    """What a reader chose; blanks choose nothing."""

    q: str = ""
    type_id: int | None = None
    subtype: str = ""
    source_id: int | None = None
    keyword_id: int | None = None
    jurisdiction: str = "all"
    include_hidden: bool = False
    synonyms: Sequence[Synonym] = field(default_factory=tuple)

    @classmethod
    def parse(cls, args: Mapping[str, str], synonyms: Sequence[Synonym] = (), subtype_prefix: str = "podtyp-") -> Filter:
        """From request arguments; a type that begins with the prefix is a subtype; what is no number chooses nothing."""
        number = lambda k: int(args[k]) if str(args.get(k, "")).isdigit() else None
        q, kind = (args.get("q") or "").strip(), args.get("type_id") or ""
        subtype = kind[len(subtype_prefix) :] if kind.startswith(subtype_prefix) else ""
        hidden = args.get("include_sk") in ("1", "on", "true")
        wanted = args.get("jurisdikce") or "all"
        if wanted == "SK" and not hidden:
            wanted = "all"
        return cls(q, None if subtype else number("type_id"), subtype, number("source_id"), number("keyword_id"), wanted, hidden, tuple(s for s in synonyms if q and s.triggered(q)))

    def condition(self) -> Column:
        """One condition for list, count and export; columns title, description, designation, type_id, subtype, source_id,
        jurisdiction."""
        parts = []
        if self.q:
            words = [t for s in self.synonyms for t in s.terms]
            names = [d for s in self.synonyms for d in s.designations]
            found = R.contains_any([F.col("title"), F.col("description"), F.col("designation")], [self.q])
            if words:
                found = found | R.contains_any([F.col("title"), F.col("description")], words)
            if names:
                found = found | F.col("designation").isin(*names)
            parts.append(found)
        parts += [F.col(c) == v for c, v in (("type_id", self.type_id), ("source_id", self.source_id), ("subtype", self.subtype or None)) if v is not None]
        if self.jurisdiction != "all":
            parts.append(R.in_jurisdiction(F.col("jurisdiction"), self.jurisdiction))
        if not self.include_hidden:
            parts.append(R.is_public(F.col("jurisdiction"), F.col("designation")))
        return reduce(Column.__and__, parts, F.lit(True))

    def apply(self, documents: DataFrame, keywords: DataFrame | None = None) -> DataFrame:
        """documents that meet the filter; keywords (document_id, keyword_id) by a semi-join, so no row is repeated."""
        out = documents.where(self.condition())
        if self.keyword_id is not None and keywords is not None:
            chosen = keywords.where(F.col("keyword_id") == self.keyword_id).select(F.col("document_id").alias("id"))
            out = out.join(chosen, "id", "left_semi")
        return out


def compiled(when: Mapping, facts: Mapping[str, Column] | None = None) -> Column:
    """A condition given as data: all entries hold. `any` is a list of conditions one of which holds; `x_regex` a pattern
    as it stands (it says itself whether case counts); `has_document_type` a type other than the one for unsorted
    documents; facts (a name's own column) are compared with true or false; a list is a choice, other values are equal.
    A candidate without a tier is of the first."""

    def one(name: str, wanted) -> Column:
        if name == "any":
            return reduce(Column.__or__, [compiled(w, facts) for w in wanted], F.lit(False))
        if facts and name in facts:
            return F.coalesce(facts[name], F.lit(False)) == F.lit(bool(wanted))
        if name.endswith("_regex"):
            return F.coalesce(F.col(name[: -len("_regex")]), F.lit("")).rlike(f"(?U){wanted}")
        if name == "has_document_type":
            return (~F.coalesce(F.col("document_type"), F.lit("")).isin("", UNSORTED)) == F.lit(bool(wanted))
        values = wanted if isinstance(wanted, list | tuple) else [wanted]
        if name == "tier":
            return F.coalesce(F.col("tier"), F.lit(1)).isin(*values)
        some = [v for v in values if v is not None]
        hit = F.col(name).isin(*some) if some else F.lit(False)
        return F.coalesce(hit, F.lit(False)) | F.col(name).isNull() if None in values else F.coalesce(hit, F.lit(False))

    return reduce(Column.__and__, [one(k, v) for k, v in when.items()], F.lit(True))


def decided(candidates: DataFrame, rules: Sequence[Mapping], facts: Mapping[str, Column] | None = None) -> DataFrame:
    """candidates with rule and action of the first rule that they meet. The last rule must hold for all."""
    if rules[-1].get("when"):
        raise ValueError("the last rule must have no condition")
    pick: Callable[[str], Column] = lambda what: R.first_rule([(r[what], compiled(r["when"], facts)) for r in rules[:-1]], rules[-1][what])
    return candidates.withColumns({"rule": pick("id"), "action": pick("action")})


def model_action(recommendation: Column, category: Column, confidence: Column, *, automatic: Mapping[str, str], related: Column, needs_relation: Sequence[str] = (), decline: float, accept: float) -> Column:
    """propose, reject, defer or recommend, from a model's answer: approved categories act from `decline` on (a rejection
    only where the model rejects, some only for related candidates); an acceptance in scope becomes a proposal from `accept`."""
    out = F.when((recommendation == "accept") & (category == "in_scope") & (confidence >= accept), "propose").otherwise("recommend")
    for name, action in automatic.items():
        ok = (category == name) & (confidence >= decline)
        if name in needs_relation:
            ok = ok & F.coalesce(related, F.lit(False))
        if action == "reject":
            ok = ok & (recommendation == "reject")
        out = F.when(ok, action).otherwise(out)
    return out


def proposal_faults(types: Sequence[str], languages: Sequence[str], taken: Column) -> Column:
    """Faults of a proposal (title, document_type, language, areas array): empty if it can be stored."""
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    tests = (
        ("title", blank("title")), ("type", ~F.coalesce(F.col("document_type").isin(*types), F.lit(False))),
        ("language", ~F.coalesce(F.col("language").isin(*languages), F.lit(False))), ("areas", F.size(F.coalesce("areas", F.array().cast("array<int>"))) == 0), ("designation", F.coalesce(taken, F.lit(False))),
    )
    return F.array_compact(F.array(*[F.when(c, n) for n, c in tests]))


def duplicates(candidates: DataFrame, documents: DataFrame) -> DataFrame:
    """id, document of candidates (id, keys array, language, norm) that are in the catalogue (document, keys array, language,
    norm) already: a shared key in one language (none is CS), else, where no key is shared, an equal normal designation."""
    language = lambda: F.coalesce(F.nullif("language", F.lit("")), F.lit("CS"))
    c = candidates.select("id", language().alias("lang"), F.explode("keys").alias("key"))
    d = documents.select("document", language().alias("doc_lang"), F.explode("keys").alias("key"))
    acts = c.join(d, "key").groupBy("id").agg(F.min(F.when(F.col("lang") == F.col("doc_lang"), F.col("document"))).alias("document"))
    rest = candidates.where(F.coalesce("norm", F.lit("")) != "").join(acts.select("id"), "id", "left_anti").select("id", "norm")
    names = documents.where(F.coalesce("norm", F.lit("")) != "").groupBy("norm").agg(F.min("document").alias("document"))
    return acts.where("document is not null").union(rest.join(names, "norm").select("id", "document"))


def accepted_rows(candidates: DataFrame) -> dict[str, DataFrame]:
    """What accepted candidates (key, designation, title, language, url, areas array, repeals array) add: documents, their
    first versions, links to areas and edges to what they repeal. Keys are hashes, so a repeated run gives the same rows."""
    a = candidates.where("status = 'accepted'").withColumn("id", F.xxhash64("key"))
    return {
        "document": a.select("id", F.nullif("designation", F.lit("")).alias("designation"), "title", "language", "url", F.lit(True).alias("needs_review")),
        "version": a.select(F.col("id").alias("document_id"), F.lit(1).alias("version"), F.lit(True).alias("is_current"), F.lit("active").alias("state")),
        "area": a.select(F.col("id").alias("document_id"), F.explode("areas").alias("area")).distinct(),
        "relation": a.select(F.col("designation").alias("src"), F.explode("repeals").alias("dst"), F.lit("REPEALS").alias("kind")).where("src <> dst").distinct(),
    }
