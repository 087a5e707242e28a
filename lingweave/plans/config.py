"""Typed settings of a mining run, with their defaults and mutual conditions."""

from __future__ import annotations

from dataclasses import dataclass, field, fields

UNTIL = ["crawl", "preprocess", "shard", "split", "translate", "tokenise", "docalign", "segalign", "repair", "score", "filter"]


@dataclass
class Config:
    lang1: str = "en"
    lang2: str = "fr"
    until: str = "filter"
    document_aligner: str = "translation"  # translation, lexicon or vectors
    segment_aligner: str = "bleu"  # bleu, length or vector
    doc_threshold: float = 0.1
    seg_threshold: float = 0.1
    ngram: int = 2
    min_df: int = 2
    max_df: int = 10_000
    df_sample: int = 1
    shards: int = 8  # a power of two's exponent
    batch_mb: int = 1024
    scope: list[str] = field(default_factory=list)
    languages: list[str] = field(default_factory=list)
    boilerplate_cleaning: bool = False
    paragraph_ids: bool = False
    prune: int = 80
    prune_by: str = "words"
    sentence_breaks: dict[str, list[str]] = field(default_factory=dict)
    dictionary: str | None = None
    max_word_occurrences: int = 15
    candidates: int = 10
    rank_threshold: float = 0.0
    repair: bool = True
    aggressive_dedup: bool = True
    score_pairs: bool = False
    pair_threshold: float = 0.0
    elrc: bool = False
    deduped: bool = True
    tmx: bool = False
    granularity: list[str] = field(default_factory=lambda: ["sentences"])
    direction: str | None = None
    roam_omit: float = 0.1

    @classmethod
    def of(cls, values: dict) -> Config:
        """From a mapping; unknown names, wrong types and broken conditions are listed together."""
        known = {f.name: f for f in fields(cls)}
        errors = [f"unknown: {k}" for k in values if k not in known]
        out = cls()
        for k, v in values.items():
            if k in known:
                now = getattr(out, k)
                if now is not None and v is not None:
                    if isinstance(now, bool) != isinstance(v, bool) or not isinstance(v, (int, float) if isinstance(now, float) else type(now)):
                        errors.append(f"{k}: {type(now).__name__} expected, {v!r} found")
                        continue
                setattr(out, k, v)
        errors += out.problems()
        if errors:
            raise ValueError("; ".join(errors))
        return out

    def problems(self) -> list[str]:
        p = []
        if self.lang1 == self.lang2:
            p.append("lang1 and lang2 are the same")
        if self.until not in UNTIL:
            p.append(f"until: none of {', '.join(UNTIL)}")
        if self.document_aligner not in ("translation", "lexicon", "vectors"):
            p.append("document_aligner: translation, lexicon or vectors")
        if self.segment_aligner not in ("bleu", "length", "vector"):
            p.append("segment_aligner: bleu, length or vector")
        if self.segment_aligner == "bleu" and self.document_aligner != "translation":
            p.append("the bleu aligner needs translated documents")
        if self.segment_aligner == "vector" and self.document_aligner != "vectors":
            p.append("the vector aligner needs document vectors")
        if self.segment_aligner == "length" and self.document_aligner == "translation" and not self.dictionary:
            p.append("the length aligner on translations needs a dictionary")
        if not set(self.granularity) <= {"sentences", "documents"} or not self.granularity:
            p.append("granularity: sentences, documents")
        elif "sentences" not in self.granularity:
            p.append("documents are only given along with sentences")
        if self.direction not in (None, f"{self.lang1}2{self.lang2}", f"{self.lang2}2{self.lang1}"):
            p.append(f"direction: {self.lang1}2{self.lang2} or {self.lang2}2{self.lang1}")
        if not 0 <= self.shards <= 30 or self.batch_mb < 1 or self.df_sample < 1:
            p.append("shards, batch_mb or df_sample out of range")
        if not 1 <= self.ngram or not self.min_df <= self.max_df:
            p.append("ngram or document frequencies out of range")
        return p

    @property
    def swapped(self) -> bool:
        return self.direction == f"{self.lang2}2{self.lang1}"
