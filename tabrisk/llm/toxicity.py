"""Toxicity from a learned lexicon, matched through misspellings and read in context.

1. Lexicon: over all training documents, words are counted by document and
   label; the ``LEXICON_TERMS`` words with the strongest association with toxic
   documents become terms, weighted by their log odds.
2. Matching: the terms form one trie; a Levenshtein automaton of the word at hand
   walks it (past the branches that an index rules out) and finds every term within the edit limit (none for terms under
   four letters, one under ten, two from there on). Adjacent letters that
   swapped places count as one edit.
3. Context: hits are summed in windows of ``WINDOW`` words. A hit inside
   quotation marks counts as quotation and one outside as abuse; exact and
   misspelled hits are summed apart.
4. A logistic regression over these sums, fitted on all training documents,
   gives the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import append, broadcast_if_small, crc_mod, cut_lineage

LEXICON_TERMS = 512
MIN_DOCS = 4
MIN_LOG_ODDS = 2.0
#: Least G-squared of a term (a chance of about one in 100,000 for a word without association).
MIN_G = 20.0
WINDOW = 12
THRESHOLD = 0.7
CACHE_WORDS = 250_000
CACHE_BRANCHES = 20_000
#: Words of the lexicon counts that a task holds before it passes them on.
COUNT_WORDS = 200_000
WORD = re.compile(r"[^\W\d_]+")
QUOTES = re.compile(r'["“”„«»]')
FEATURES = ["exact", "fuzzy", "quoted", "peak"]


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def limit_of(term: str) -> int:
    """Edits allowed for a term."""
    return 0 if len(term) < 4 else 1 if len(term) < 10 else 2


def _mask(word: str) -> int:
    """The set of letters as bits (some letters share one)."""
    out = 0
    for c in word:
        out |= 1 << (ord(c) & 63)
    return out


def _may_be_two(word: str, term: str) -> bool:
    """Whether two edits at most, a swap being one, may part the two. They lie at the ends of what is left without common ends."""
    n, m = len(word), len(term)
    i = 0
    while i < n and i < m and word[i] == term[i]:
        i += 1
    while n > i and m > i and word[n - 1] == term[m - 1]:
        n, m = n - 1, m - 1
    n, m = n - i, m - i
    if n < 3 and m < 3:
        return True
    w, t = word[i : i + n], term[i : i + m]
    if not n or not m:
        return False
    # what the first and the last edit take off either: one letter of one, one of both, or two that are swapped
    starts = [(1, 0), (0, 1), (1, 1)] + [(2, 2)] * (w[:2] == t[1::-1])
    ends = [(1, 0), (0, 1), (1, 1)] + [(2, 2)] * (w[-2:] == t[:-3:-1])
    return any(n - a - c == m - b - d and w[a : n - c] == t[b : m - d] for a, b in starts for c, d in ends if a + c <= n and b + d <= m)


def _trie(terms: Iterable[str]) -> dict:
    """Letter to node below, and "" to the term that ends in a node."""
    root: dict = {}
    for t in terms:
        node = root
        for c in t:
            node = node.setdefault(c, {})
        node[""] = t
    return root


class Lexicon:
    """Terms with weights, as one trie; ``match`` gives the best term of a word as (weight, edits). With ``swaps``, adjacent letters that swapped places are one edit, else two.

    A Levenshtein automaton of the word walks the trie. An index tells first which
    terms a word may be near at all, so that the walk keeps to their branches; it
    never changes a result (``match(word, filtered=False)`` walks all branches).
    Terms that may have one edit share with every word near them a form with at
    most one letter left out (or the other letter, where two swapped places).
    Terms that may have two keep one of three parts whole: the first where it was,
    the last at the word's end, the middle one moved by two places at most. Only a
    swap across a cut breaks two parts; so such a term is filed once more for each
    choice of cuts, with the letters around them swapped and that many edits less.
    What the parts find must also be alike between its first and its last difference.
    """

    def __init__(self, weights: dict[str, float], swaps: bool = False):
        self.weights, self.swaps = weights, swaps
        self.masks = {t: _mask(t) for t in weights}
        self.trie = _trie(weights)
        self.branches: dict[tuple[str, ...], dict] = {}  # the trie cut down to sets of terms that words may be near
        # forms with a letter left out, to the terms; for each length of a word, parts (the inner ones with their place) to the terms
        self.shorter: dict[str, set[str]] = {}
        self.first: dict[int, dict[str, set[str]]] = {}
        self.last: dict[int, dict[str, set[str]]] = {}
        self.inner: dict[int, dict[tuple[int, str], set[str]]] = {}
        for t in weights:
            n, k = len(t), limit_of(t)
            if k == 1:
                for form in {t, *(t[:i] + t[i + 1 :] for i in range(n))}:
                    self.shorter.setdefault(form, set()).add(t)
            if k < 2:
                continue
            cuts = [n * i // (k + 1) for i in range(k + 2)]
            for crossed in range(k + 1 if swaps else 1):
                for at in combinations(cuts[1:-1], crossed):
                    v = list(t)
                    for c in at:
                        v[c - 1], v[c] = v[c], v[c - 1]
                    self._file(t, "".join(v), cuts, k - crossed)
        self.longest = max((len(t) + limit_of(t) for t in weights), default=0)
        self.one = max((len(t) + 1 for t in weights if limit_of(t) == 1), default=0)
        self.most = max(map(limit_of, weights), default=0)
        self.widths = {n: (sorted({len(x) for x in self.first[n]}), sorted({len(x) for x in self.last[n]}), sorted({(at, len(x)) for at, x in self.inner[n]})) for n in self.first}

    def _file(self, term: str, form: str, cuts: list[int], k: int) -> None:
        parts = [form[a:b] for a, b in zip(cuts, cuts[1:])]
        for n in range(len(term) - k, len(term) + k + 1):
            first, last, inner = (x.setdefault(n, {}) for x in (self.first, self.last, self.inner))
            first.setdefault(parts[0], set()).add(term)
            last.setdefault(parts[-1], set()).add(term)
            for at, part in list(zip(cuts, parts))[1:-1]:
                for move in range(-k, k + 1):
                    inner.setdefault((at + move, part), set()).add(term)

    def may_match(self, word: str) -> list[str]:
        """Terms of which the word may be within the edits; no other term is."""
        n, found = len(word), []
        if 3 <= n <= self.one:
            shorter = self.shorter
            if word in shorter:
                found += shorter[word]
            for i in range(n):
                form = word[:i] + word[i + 1 :]
                if form in shorter:
                    found += shorter[form]
        if n in self.widths:
            first, last, spots = self.widths[n]
            table = self.first[n]
            for m in first:
                if (part := word[:m]) in table:
                    found += table[part]
            table = self.last[n]
            for m in last:
                if (part := word[-m:]) in table:
                    found += table[part]
            table = self.inner[n]
            for at, m in spots:
                if (key := (at, word[at : at + m])) in table:
                    found += table[key]
        if not found:
            return found
        own, near = _mask(word), []
        for t in set(found):
            letters, k = self.masks[t], limit_of(t)
            if (own & ~letters).bit_count() > k or (letters & ~own).bit_count() > k:
                continue
            if k == 1 or _may_be_two(word, t):
                near.append(t)
        return near

    def match(self, word: str, filtered: bool = True) -> tuple[float, int] | None:
        """The term with the fewest edits, of those the heaviest."""
        if word in self.weights:
            return self.weights[word], 0
        trie, most = self.trie, self.most
        if filtered:
            near = tuple(sorted(self.may_match(word)))
            if not near:
                return None
            trie, most = self.branches.get(near), max(map(limit_of, near))
            if trie is None:
                if len(self.branches) >= CACHE_BRANCHES:
                    self.branches = {}
                trie = self.branches[near] = _trie(near)
        best = None
        for term, edits in self.intersect(word, most, trie).items():
            if edits <= limit_of(term) and (best is None or (edits, -self.weights[term]) < (best[1], -best[0])):
                best = self.weights[term], edits
        return best

    def intersect(self, word: str, most: int, trie: dict) -> dict[str, int]:
        """Terms of the trie that the word's Levenshtein automaton accepts, with their edits.

        A state of the automaton is (letters of the word read, edits spent). The
        walk keeps pairs of a trie node and a state: a letter read by both moves
        on for nothing; an edit drops a letter of the word, of the term, takes
        one for the other, or reads two letters in each other's place.
        """
        n, found = len(word), {}
        letters = [*word, ""]  # the end of the word is read like the end of a term
        todo, seen = [(trie, 0, 0)], set()
        while todo:
            node, i, e = todo.pop()
            while True:  # the part of the walk that has no choice left
                if "" in node and e + n - i <= most:
                    t = node[""]
                    found[t] = min(found.get(t, most + 1), e + n - i)
                if e < most and (id(node), i, e) not in seen:
                    seen.add((id(node), i, e))
                    last = e + 1 == most  # what follows the last edit is read by both, or nothing does
                    here, then = (letters[i], letters[i + 1]) if i < n else ("", "")
                    if i < n and (not last or then in node):
                        todo.append((node, i + 1, e + 1))
                    for c, below in node.items():
                        if c:
                            if not last or here in below:
                                todo.append((below, i, e + 1))
                            if i < n and c != here and (not last or then in below):
                                todo.append((below, i + 1, e + 1))
                    if self.swaps and i + 1 < n and here != then and here in (below := node.get(then, {})) and (not last or letters[i + 2] in below[here]):
                        todo.append((below[here], i + 2, e + 1))
                node = node.get(word[i]) if i < n else None
                if node is None:
                    break
                i += 1
        return found


def quoted(text: str, start: int, end: int) -> bool:
    """Whether a place of the text lies between quotation marks of its own line."""
    a = text.rfind("\n", 0, start) + 1
    b = text.find("\n", end)
    before = len(QUOTES.findall(text, a, start))
    return before % 2 == 1 and QUOTES.search(text, end, len(text) if b < 0 else b) is not None


def context_features(text: str, words: list[str], hits: list[tuple[int, float, int]]) -> list[float]:
    """The sums of ``FEATURES`` for hits (word index, weight, edits) of a text.

    A word that comes again adds nothing to the sums of the text, nor to a window
    that it is in already; another window counts it anew.
    """
    if not hits:
        return [0.0] * len(FEATURES)
    spans = {}
    if QUOTES.search(text):
        at = {i for i, _, _ in hits}
        spans = {i: m.span() for i, m in enumerate(WORD.finditer(text)) if i in at}
    exact = fuzzy = quote = peak = 0.0
    window: dict[str, tuple[int, float]] = {}  # the last place of each word and its weight
    seen: set[tuple[str, bool]] = set()
    for i, weight, edits in hits:
        word, is_quote = words[i], bool(spans) and quoted(text, *spans[i])
        new = (word, is_quote) not in seen
        seen.add((word, is_quote))
        if is_quote:
            quote += weight * new
            continue
        if edits:
            fuzzy += weight / (1 + edits) * new
        else:
            exact += weight * new
        window = {w: x for w, x in window.items() if i - x[0] < WINDOW} | {word: (i, weight / (1 + edits))}
        peak = max(peak, sum(x for _, x in window.values()))
    level = lambda x: x / (1 + x / 12)  # log odds add up, but not without end
    return [level(exact), level(fuzzy), level(quote), level(peak)]


class _Matches(dict):
    """Words to their match, looked up in the lexicon when they first come."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.match = lexicon.match

    def __missing__(self, word: str) -> tuple[float, int] | None:
        self[word] = found = self.match(word)
        return found


def _scanner(shared):
    lexicon: Lexicon = shared.value
    matches = _Matches(lexicon)

    def batch(texts: list) -> list[pa.Array]:
        nonlocal matches
        out = np.zeros((len(texts), len(FEATURES)))
        for k, t in enumerate(texts):
            if not t:
                continue
            if len(matches) > CACHE_WORDS:
                matches = _Matches(lexicon)
            text = t.decode("utf-8", "replace").lower()
            words = WORD.findall(text)
            got = [matches[w] for w in words]
            if any(got):
                out[k] = context_features(text, words, [(i, *g) for i, g in enumerate(got) if g])
        return [pa.array(out[:, j]) for j in range(len(FEATURES))]

    return batch


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = {0: Counter(), 1: Counter()}

    def give():
        for label, c in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array([label] * len(c), pa.int32()), pa.array(list(c.values()), pa.int64())], ["word", "label", "n"])
            c.clear()

    for b in batches:
        for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            counts[label].update(set(words_of(text or "")))
            if sum(map(len, counts.values())) > COUNT_WORDS:
                yield from give()
    yield from give()


def learn_lexicon(training: DataFrame, terms: int = LEXICON_TERMS) -> dict[str, float]:
    """Log odds of the terms from ``training`` (text, label), counted over all of its rows.

    The strongest by the G-squared statistic are kept; none if a label is missing.
    """
    totals = {r["label"]: r["n"] for r in training.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return {}
    by = training.select("text", "label").mapInArrow(_word_counts, "word string, label int, n bigint")
    c = by.groupBy("word").agg(F.sum(F.col("n") * F.col("label")).alias("a"), F.sum(F.col("n") * (1 - F.col("label"))).alias("b"))
    c = c.where(F.col("a") >= MIN_DOCS).withColumn("w", F.log((F.col("a") + 0.5) / (toxic + 1.0)) - F.log((F.col("b") + 0.5) / (clean + 1.0)))
    share = (F.col("a") + F.col("b")) / float(toxic + clean)
    part = lambda n, total: F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (share * float(total)))).otherwise(0.0)
    c = c.where(F.col("w") >= MIN_LOG_ODDS).withColumn("g", part("a", toxic) + part("b", clean))
    return {r["word"]: r["w"] for r in c.where(F.col("g") * 2 >= MIN_G).orderBy(F.desc("g"), "word").limit(terms).select("word", "w").collect()}


def held_out(key: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id's text modulo 3 is 1 (a null id is not held out)."""
    return F.coalesce(crc_mod(key, 3) == 1, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    ``labels`` has an id and a 0/1 label; null labels, labels without a document
    and labels of held-out ids teach nothing. Null and empty texts are scored as
    texts without a hit. Repeated rows are scored each. Without labels of both
    kinds every score is the share of toxic ones (0 if there are none at all).
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label")).where(F.col("label").isin(0, 1) & ~held_out())
    known = cut_lineage(known.where("doc_id is not null"))
    taught = rows.join(broadcast_if_small(known), "doc_id")
    weights = learn_lexicon(taught)
    shared = docs.sparkSession.sparkContext.broadcast(Lexicon(weights, swaps=True))
    marks = append(rows.withColumn("held_out", held_out()), ["doc_id", "held_out"], "text", ", ".join(f"{f} double" for f in FEATURES), lambda: _scanner(shared))
    marks = cut_lineage(marks)
    z = _logit(marks.join(known, "doc_id").where(~F.col("held_out")))
    return marks.select("doc_id", "held_out", z.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int")).withColumnRenamed("doc_id", id_col)


def _logit(training: DataFrame) -> Column:
    """The fitted probability as an expression of the features."""
    n = training.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < n[1] < n[0]:
        return F.lit(float(n[1]) / n[0] if n[0] else 0.0)
    t = training.select(array_to_vector(F.array(*FEATURES)).alias("features"), F.col("label").cast("double").alias("label"))
    m = LogisticRegression(maxIter=50, regParam=1e-4, standardization=True).fit(t)
    z = F.lit(float(m.intercept))
    for f, c in zip(FEATURES, m.coefficients):
        z = z + F.lit(float(c)) * F.col(f)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
