"""Places of lexicon words in running text: the one thing that built-ins do not return."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import functions as F

SPANS = "array<struct<start: int, end: int, surface: string, pattern: string, kind: string, rank: int>>"


#: How the name of a rule begins that is a keyword between word borders; the keyword follows.
KEYWORD = "keyword:"


class _Keywords:
    """All keywords in one expression: at each place the longest is found, and with it those that begin it."""

    def __init__(self, words: list[str]):
        self.words = sorted(set(words), key=lambda w: (-len(w), w))
        self.expression = re.compile(r"(?<!\w)(?=(?:" + "|".join(f"({re.escape(w)})" for w in self.words) + r")(?!\w))", re.I) if words else None
        heads = [re.compile(re.escape(w) + r"(?!\w)", re.I) for w in self.words]
        self.heads = [[k for k, h in enumerate(heads) if len(self.words[k]) <= len(w) and h.match(w)] for w in self.words]

    def places(self, text: str) -> Iterator[tuple[str, int, int]]:
        """(keyword, start, end), those of one keyword without overlap."""
        if self.expression:
            after = [0] * len(self.words)
            for m in self.expression.finditer(text):
                start = m.start()
                for k in self.heads[m.lastindex - 1]:
                    if start >= after[k]:
                        after[k] = end = start + len(self.words[k])
                        yield self.words[k], start, end


def span_finder(rules: list[tuple[str, str, str]]) -> Callable:
    """A column function to all places of the rules (expression, kind, name), each with its rank in the list; a batch of texts at a time.

    Keywords are found in one pass over a text, whatever their number; each other rule takes a pass of its own over texts that some of them match.
    """
    by_word: dict[str, list[tuple[str, str, int]]] = {}
    compiled = []
    for rank, (expression, kind, name) in enumerate(rules):
        if name.startswith(KEYWORD):
            by_word.setdefault(name.removeprefix(KEYWORD), []).append((kind, name, rank))
        else:
            compiled.append((re.compile(expression, re.I), kind, name, rank))
    keywords = _Keywords(list(by_word))
    hint = re.compile("|".join(f"(?:{r.pattern})" for r, _, _, _ in compiled), re.I) if compiled else None

    def find(texts: pd.Series) -> pd.Series:
        def span(text: str, start: int, end: int, kind: str, name: str, rank: int) -> dict:
            return {"start": start, "end": end, "surface": text[start:end], "pattern": name, "kind": kind, "rank": rank}

        def one(text: str | None) -> list[dict]:
            if not text:
                return []
            found = [span(text, a, b, *rule) for word, a, b in keywords.places(text) for rule in by_word[word]]
            if hint and hint.search(text):
                found += [span(text, *m.span(), kind, name, rank) for r, kind, name, rank in compiled for m in r.finditer(text)]
            return found

        return texts.map(one)

    return F.pandas_udf(find, SPANS)
