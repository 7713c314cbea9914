"""Toxicity by Levenshtein automata over a lexicon trie, scored in context.

The lexicon is learned: whole words and word beginnings (stems) that occur in toxic rather than
in clean labelled texts. Its trie is intersected with Levenshtein automata (one error for terms
of five letters or more, two from nine on; stems must match exactly) and made deterministic where
words go, so a word is matched by table look-ups, letter by letter. Of the different words of a run of texts,
those that a sieve of hashes can't rule out go through the table together; each worker fills its own table.

A hit counts less if it stands between quotation marks, and more if other hits are near: the
context window has `WINDOW` words on both sides. A logistic regression on a text's hits gives the
score. Each labelled text's own share in a term's weight is taken out before the regression sees
it, so that rare terms don't look surer than they are.

Lexicon and regression are fitted on at most `TOXIC_ROWS` and `CLEAN_ROWS` labelled rows, chosen
by a hash of their id; every row is scored on its whole text. The sample bounds the lexicon, and
every chosen term is searched. Words of any length are learned and matched: runs of letters and of the digits 0-9.

Defined results: null and empty texts have the score of a text without hits; without labelled
rows of both kinds the score is the toxic share (0 without any); repeated rows are scored one by
one; labels that are null are not learned from; other columns are not looked at.
"""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import GOLDEN, claim, code_points, column, letters, mix, text_runs, with_new_columns, written

TOXIC_ROWS, CLEAN_ROWS = 6000, 9000
MOST_STATES = 60_000
MOST_ERRORS = 2
SIEVE_BITS = 21
BASE = 0xF1357AEA2E62A9C5
DOWN = np.uint64(pow(BASE, -1, 2**64))
BLOCK_LETTERS = 100_000
WORD = r"[\p{L}0-9]+"
LEAST_TOXIC = 4
LEAST_PURITY = 0.75
STEM = (4, 8)
WINDOW = 6
THRESHOLD = 0.3
QUOTES = "\"“”„«»‹›"
OTHER = 1  # class of letters that no term has; 0 ends a word
UNKNOWN, AS_OTHER = -1, -2  # in an automaton's table


@dataclass
class Term:
    text: str
    stem: bool
    toxic: int
    clean: int

    @property
    def errors(self) -> int:
        return 0 if self.stem or len(self.text) < 5 else 1 if len(self.text) < 9 else 2


class Trie:
    """The lexicon's trie. A state of the automaton is a rising list of 4 * node + errors, each node with the fewest."""

    def __init__(self, terms: list[Term]):
        self.children: list[dict[int, int]] = [{}]
        self.reach = [0]  # most errors of any whole word at or below
        self.whole, self.stem = [-1], [-1]  # the term that ends here
        self.alphabet = {c: i + 2 for i, c in enumerate(sorted({c for t in terms for c in t.text}))}
        for k, term in enumerate(terms):
            at = 0
            for c in term.text:
                self.reach[at] = max(self.reach[at], term.errors)
                step = self.children[at].setdefault(self.alphabet[c], len(self.children))
                if step == len(self.children):
                    self.children.append({})
                    self.reach.append(0)
                    self.whole.append(-1)
                    self.stem.append(-1)
                at = step
            self.reach[at] = max(self.reach[at], term.errors)
            (self.stem if term.stem else self.whole)[at] = k

    def closed(self, items: dict[int, int]) -> array:
        """Adds what is reached by leaving out letters of a term."""
        children, reach = self.children, self.reach
        todo = [(node, e) for node, e in items.items() if e < reach[node]]
        while todo:
            node, e = todo.pop()
            if items[node] < e:
                continue
            e += 1
            for child in children[node].values():
                if e <= reach[child] and items.get(child, 99) > e:
                    items[child] = e
                    todo.append((child, e))
        return array("i", sorted(4 * node + e for node, e in items.items()))

    def step(self, state: array, c: int) -> array:
        children, reach = self.children, self.reach
        out: dict[int, int] = {}
        for item in state:
            node, e = item >> 2, item & 3
            own = children[node]
            child = own.get(c)
            if child is not None and out.get(child, 99) > e:
                out[child] = e
            e += 1
            if e <= reach[node]:
                if out.get(node, 99) > e:
                    out[node] = e  # a letter too many
                for child in own.values():  # a wrong letter
                    if e <= reach[child] and out.get(child, 99) > e:
                        out[child] = e
        return self.closed(out)


class Sieve:
    """Leaves out words that no term can match, by hashes; what it lets through may still match none.

    Words within d errors of each other become equal when up to d letters are taken out of each. So hashes of terms without up
    to as many letters as they have errors go into a table, and a word is kept if one of its own is there. Stems are looked up by a
    word's beginnings. The hash is a polynomial, since it is that of a word without some letters at little cost.
    """

    def __init__(self, terms: list[Term]):
        self.tables = np.zeros((MOST_ERRORS + 2, 2**SIEVE_BITS), dtype=bool)  # terms by errors, then stems
        self.known: list[np.ndarray] = []  # the hashes themselves, sorted
        self.longest = max((len(t.text) + t.errors for t in terms), default=0)
        self.powers = np.full(self.longest + 2, BASE, dtype=np.uint64)
        self.powers[0] = 1
        np.cumprod(self.powers, out=self.powers)
        self.stems = sorted({len(t.text) for t in terms if t.stem})
        self.lengths = []  # of words that terms with so many errors can match
        for d in range(MOST_ERRORS + 1):
            some = [t.text for t in terms if not t.stem and t.errors == d]
            sizes = np.array(list(map(len, some)), dtype=np.int64)
            self.lengths.append((int(sizes.min()) - d, int(sizes.max()) + d) if some else (1, 0))
            self.note(d, [h for _, h in self.hashes(*self.sums("".join(some), sizes), d)])
        stems = []
        for k in self.stems:
            some = [t.text for t in terms if t.stem and len(t.text) == k]
            sums, first, _ = self.sums("".join(some), np.full(len(some), k))
            stems.append(mix(sums[first + k] - sums[first]))
        self.note(-1, stems)

    def note(self, table: int, hashes: list[np.ndarray]) -> None:
        self.known.append(np.unique(np.concatenate([np.empty(0, np.uint64), *hashes])))
        self.tables[table, self.known[-1] >> np.uint64(64 - SIEVE_BITS)] = True

    def hits(self, table: int, hashes: np.ndarray) -> np.ndarray:
        """Which of the hashes are known: most are not, by a look at their first bits."""
        near = np.flatnonzero(self.tables[table, hashes >> np.uint64(64 - SIEVE_BITS)])
        known = self.known[table]
        at = np.searchsorted(known, hashes[near])
        return near[known[np.minimum(at, len(known) - 1)] == hashes[near]] if len(known) else near[:0]

    def sums(self, codes: str | np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Running sums of the letters of words that lie one after the other, where each word's begin, and how long they are."""
        if isinstance(codes, str):
            codes = np.frombuffer(codes.encode("utf-32-le"), np.uint32)
        first = np.cumsum(sizes) - sizes
        at = np.arange(len(codes)) - np.repeat(first, sizes)
        sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(mix(codes.astype(np.uint64) + GOLDEN) * self.powers[at], out=sums[1:])
        return sums, first, sizes

    def hashes(self, sums: np.ndarray, first: np.ndarray, sizes: np.ndarray, d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word, hash) of all words without up to d of their letters."""
        whole = sums[first + sizes] - sums[first]
        yield np.arange(len(sizes)), mix(whole)
        for i in range(int(sizes.max(initial=0)) if d else 0):
            own = np.flatnonzero(sizes > i)
            low, one, end = sums[first[own]], sums[first[own] + i], sums[first[own] + i + 1]
            before, rest = one - low, sums[first[own] + sizes[own]]
            yield own, mix(before + (rest - end) * DOWN)
            if d > 1:
                more = sizes[own] - i - 1  # letters behind this one
                word = np.repeat(np.arange(len(own)), more)
                k = first[own][word] + i + 1 + np.arange(len(word)) - np.repeat(np.cumsum(more) - more, more)
                yield own[word], mix(before[word] + (sums[k] - end[word]) * DOWN + (rest[word] - sums[k + 1]) * DOWN * DOWN)

    def kept(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which of the words may match a term."""
        out = np.zeros(len(starts), dtype=bool)
        for k in self.stems:
            long = np.flatnonzero(sizes >= k)
            at = starts[long][:, None] + np.arange(k)
            out[long[self.hits(-1, mix((mix(codes[at].astype(np.uint64) + GOLDEN) * self.powers[:k]).sum(axis=1, dtype=np.uint64)))]] = True
        for d, (low, high) in enumerate(self.lengths):
            some = np.flatnonzero((sizes >= low) & (sizes <= high) & ~out)
            own = sizes[some]
            at = np.repeat(starts[some] - np.cumsum(own) + own, own) + np.arange(own.sum())
            for word, hashes in self.hashes(*self.sums(codes[at], own), d):
                out[some[word[self.hits(d, hashes)]]] = True
        return out


class Automaton:
    """The trie under all allowed errors, made deterministic for as much of it as words walk through.

    State 0 is dead, 1 the start. A state's row of the table is filled where words go on; letters that
    none of its nodes has lead to the same place. Between blocks of words, a table above
    `most_states` is emptied, so it stays bounded whatever the lexicon and the words are.
    """

    def __init__(self, terms: list[Term], most_states: int = MOST_STATES):
        self.trie, self.most_states = Trie(terms), most_states
        self.errors = [t.errors for t in terms]
        self.n_classes = len(self.trie.alphabet) + 2
        self.classes, self.sieve = letter_classes(self.trie.alphabet), Sieve(terms)
        self.clear()

    def __getstate__(self) -> dict:
        kept = ("trie", "most_states", "errors", "n_classes", "sieve")
        return {k: self.__dict__[k] for k in kept}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.classes = letter_classes(self.trie.alphabet)
        self.clear()

    def clear(self) -> None:
        self.states: list[bytes] = []
        self.numbers: dict[bytes, int] = {}
        self.table = np.full((64, self.n_classes), UNKNOWN, dtype=np.int32)
        self.whole, self.distance, self.stem = (np.full(64, -1, dtype=np.int32) for _ in range(3))
        self.number(array("i"))
        self.number(self.trie.closed({0: 0}))

    def number(self, state: array) -> int:
        """The number of a state, which is a new one if it was not met before."""
        key = state.tobytes()
        k = self.numbers.setdefault(key, len(self.states))
        if k < len(self.states):
            return k
        self.states.append(key)
        if k == len(self.table):
            self.table = np.concatenate([self.table, np.full_like(self.table, UNKNOWN)])
            self.whole, self.distance, self.stem = (np.concatenate([x, np.full_like(x, -1)]) for x in (self.whole, self.distance, self.stem))
        trie, letters = self.trie, set()
        best = (99, -1)
        for item in state:
            node, e = item >> 2, item & 3
            letters.update(trie.children[node])
            term = trie.whole[node]
            if term >= 0 and e <= self.errors[term]:
                best = min(best, (e, term))
            if e == 0 and trie.stem[node] >= 0:
                self.stem[k] = trie.stem[node]
        if best[1] >= 0:
            self.distance[k], self.whole[k] = best
        row = [AS_OTHER] * self.n_classes
        for c in letters:
            row[c] = UNKNOWN
        row[OTHER] = UNKNOWN if state else 0
        self.table[k] = row
        return k

    def next(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The state behind each state and letter."""
        reached = self.table[state, c]
        other = reached == AS_OTHER
        if other.any():
            c = np.where(other, OTHER, c)
            reached = self.table[state, c]
        new = np.flatnonzero(reached == UNKNOWN)
        if len(new):
            for key in np.unique(state[new].astype(np.int64) * self.n_classes + c[new]).tolist():
                k, letter = divmod(key, self.n_classes)
                found = self.number(self.trie.step(array("i", self.states[k]), letter))
                self.table[k, letter] = found
            reached = self.table[state, c]
        return reached

    def search(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The term for the word at each start, or -1, and its distance; -1 is that of stems."""
        term = np.full(len(starts), -1, dtype=np.int32)
        far = np.full(len(starts), -1, dtype=np.int32)
        ends, low = np.cumsum(sizes), 0
        while low < len(starts):
            high = max(low + 1, int(np.searchsorted(ends, ends[low] - sizes[low] + BLOCK_LETTERS, "right")))
            if len(self.states) > self.most_states:
                self.clear()
            some = low + np.flatnonzero(self.sieve.kept(codes, starts[low:high], sizes[low:high]))
            term[some], far[some] = self.walk(codes, starts[some])
            low = high
        return term, far

    def walk(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        term = np.full(len(starts), -1, dtype=np.int32)
        far = np.full(len(starts), -1, dtype=np.int32)
        alive = np.arange(len(starts))
        state = np.ones(len(starts), dtype=np.int32)
        at = starts.copy()
        while len(alive):
            c = self.classes[codes[at]]
            over = c == 0  # each text has a 0 behind it, so no word runs on into the next
            if over.any():
                ended, who = state[over], alive[over]
                hit = self.whole[ended]
                some = hit >= 0
                term[who[some]], far[who[some]] = hit[some], self.distance[ended[some]]
                alive, state, at, c = alive[~over], state[~over], at[~over], c[~over]
            state = self.next(state, c)
            stem = self.stem[state]
            some = stem >= 0
            term[alive[some]] = stem[some]
            live = state > 0
            alive, state, at = alive[live], state[live], at[live] + 1
        return term, far


def letter_classes(alphabet: dict[str, int]) -> np.ndarray:
    """For every code point: its number in the lexicon's alphabet, `OTHER` for other letters and digits, 0 for what ends a word."""
    classes = np.full(0x110000, 0, dtype=np.uint8 if len(alphabet) < 250 else np.uint16)
    classes[letters()] = OTHER
    classes[ord("0") : ord("9") + 1] = OTHER  # digits stand in for letters
    for c, k in alphabet.items():
        classes[ord(c)] = k
    return classes


@dataclass
class Hits:
    """Hits of a run of texts, in order: text, term, distance (0 for stems), quoted, others near."""

    text: np.ndarray
    term: np.ndarray
    distance: np.ndarray
    quoted: np.ndarray
    near: np.ndarray
    words: np.ndarray  # words of each text


def _distinct(codes: np.ndarray, inner: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One of each different word, and for every word the number of its own; told apart by 64 bits."""
    if not len(starts):
        return starts, starts
    at = np.flatnonzero(inner)
    heads = np.searchsorted(at, starts)
    place = np.arange(len(at)) - np.repeat(heads, np.diff(np.append(heads, len(at))))
    hashes = np.add.reduceat(mix(codes[at].astype(np.uint64) + (place.astype(np.uint64) << np.uint64(21))), heads)
    _, some, back = np.unique(hashes, return_index=True, return_inverse=True)
    return some, back


def find_hits(texts: list[str | None], own: Automaton) -> Hits:
    """The term of every word that has one: the nearest whole word, of several as near the leading one, else the longest stem."""
    codes, begins = code_points(texts)
    inner = own.classes[codes] > 0
    starts = np.flatnonzero(inner & ~np.concatenate([[False], inner[:-1]]))
    sizes = np.flatnonzero(inner & ~np.concatenate([inner[1:], [False]])) - starts + 1
    first = np.searchsorted(starts, begins)
    some, back = _distinct(codes, inner, starts)
    term, far = own.search(codes, starts[some], sizes[some])
    term, far = term[back], np.maximum(far, 0)[back]
    hits = np.flatnonzero(term >= 0)
    text = np.searchsorted(first, hits, "right") - 1
    marks = np.isin(codes, np.array([ord(q) for q in QUOTES], dtype=np.uint32))
    quoted = np.zeros(len(hits), dtype=bool)
    if marks.any() and len(hits):
        # An odd number of marks since the line began, and one more mark within the window.
        breaks = (codes == 10) | (codes == 0)
        total = np.cumsum(marks)
        line = np.maximum.accumulate(np.where(breaks, np.arange(len(codes)), 0))
        since = total[starts[hits]] - total[line[starts[hits]]]
        last = np.minimum(hits + WINDOW, first[text + 1] - 1)
        ahead = total[np.minimum(starts[last] + 40, begins[text + 1])] - total[starts[hits]]
        quoted = (since % 2 == 1) & (ahead > 0)
    near = np.zeros(len(hits), dtype=np.int32)
    if len(hits) > 1:
        close = (np.diff(hits) <= WINDOW) & (np.diff(text) == 0)
        near[1:] += close
        near[:-1] += close
    return Hits(text, term[hits], far[hits], quoted, near, np.diff(first))


FEATURES = 8


def features(term: np.ndarray, distance: np.ndarray, quoted: np.ndarray, near: np.ndarray, n_words: int, weight: np.ndarray) -> np.ndarray:
    """What the regression sees of one text; `weight` has the weight of each hit."""
    out = np.zeros(FEATURES)
    if len(term):
        meant = ~quoted
        strength = weight[meant]
        total = strength.sum()
        out[:7] = (
            strength.max(initial=0.0), np.log1p(total), np.log1p((distance > 0).sum()), np.log1p(quoted.sum()),
            np.log1p(100 * total / (n_words + 20)), np.log1p(len(np.unique(term[meant]))), np.log1p((near[meant] > 0).sum()),
        )
    out[7] = 1.0
    return out


@dataclass
class ToxicityModel:
    terms: list[Term] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((2, 0)))  # exact and misspelled, by term
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    base: float = 0.0
    own: Automaton | None = None

    def scores(self, texts: list[str | None]) -> list[float]:
        if self.own is None:
            return [self.base] * len(texts)
        hits = find_hits(texts, self.own)
        edges = np.searchsorted(hits.text, np.arange(len(texts) + 1))
        kind = (hits.distance > 0).astype(np.int64)
        out = []
        for i, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            term = hits.term[low:high]
            x = features(term, hits.distance[low:high], hits.quoted[low:high], hits.near[low:high], int(hits.words[i]), self.weights[kind[low:high], term])
            out.append(float(1 / (1 + np.exp(-(self.coefficients @ x)))))
        return out


def term_weight(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float, misspelled: np.ndarray | int = 0) -> np.ndarray:
    """Log of how much more often toxic texts have the term than clean ones; never below 0.

    Misspelled terms count apart from exact ones. They are taken for meant until clean texts hold them.
    """
    prior = np.where(misspelled, 0.05, 0.5)
    return np.maximum(np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + prior) / (n_clean + 1)), 0.0)


def candidate_counts(sample: DataFrame) -> DataFrame:
    """(term, stem, toxic, clean): in how many toxic and clean texts each word and word beginning occurs."""
    import regex

    pattern = regex.compile(WORD)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            both = defaultdict(lambda: [0, 0])
            for (word, stem, label), n in counts.items():
                both[word, stem][label] += n
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in both], pa.string()), pa.array([s for _, s in both], pa.bool_()),
                 pa.array([n[1] for n in both.values()], pa.int64()), pa.array([n[0] for n in both.values()], pa.int64())],
                names=["term", "stem", "toxic", "clean"],
            )

        for batch in batches:
            for text, label in zip(column(batch, "text").to_pylist(), column(batch, "toxic").to_pylist(), strict=True):
                found = set(pattern.findall((text or "").lower()))
                stems = {w[:k] for w in found for k in range(STEM[0], min(len(w), STEM[1] + 1))}
                counts.update((w, False, label) for w in found)
                counts.update((s, True, label) for s in stems)
                if len(counts) > 500_000:
                    yield flushed()
        yield flushed()

    parts = sample.select("text", "toxic").mapInArrow(counted, "term string, stem boolean, toxic long, clean long")
    return parts.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def chosen_terms(candidates: list[Term]) -> list[Term]:
    """Of words and stems that begin alike, the longest that lose nothing, or the stem that covers more."""
    by_support = sorted(candidates, key=lambda t: (-t.toxic, t.clean, -len(t.text), t.stem, t.text))
    kept: list[Term] = []
    stems: set[str] = set()
    support: dict[str, int] = {}  # of the best kept term with each beginning
    for term in by_support:
        beginnings = [term.text[:k] for k in range(1, len(term.text) + 1)]
        if support.get(term.text, -1) < 0.9 * term.toxic and stems.isdisjoint(beginnings):
            kept.append(term)
            if term.stem:
                stems.add(term.text)
            for beginning in beginnings:
                support.setdefault(beginning, term.toxic)
    return kept


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.3, steps: int = 50) -> np.ndarray:
    """Regularised logistic regression by Newton's method; the last column is the bias."""
    beta = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        change = np.linalg.solve(curve, gradient)
        beta -= change
        if np.abs(change).max() < 1e-8:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> ToxicityModel:
    """Fits lexicon and regression on docs (doc_id, text) and labels (doc_id, toxic); the caller has left out the rest.

    The labels' ids are sampled before they meet the texts, so only the sample's texts are moved.
    """
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(F.col("toxic").isin(0, 1)).distinct()
    sizes = {int(r[0]): r[1] for r in labels.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return ToxicityModel(base=1.0 if n_toxic else 0.0)
    share = {1: min(1.0, toxic_rows / n_toxic), 0: min(1.0, clean_rows / n_clean)}
    limit = F.when(F.col("toxic") == 1, share[1] * 1e6).otherwise(share[0] * 1e6)
    chosen = labels.filter(F.expr("pmod(xxhash64(doc_id, 'toxicity'), 1000000)") < limit)
    # About toxic_rows + clean_rows ids, 12 bytes each, whatever the size of the tables.
    sample = written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "toxicity_sample")

    used = {int(r[0]): r[1] for r in sample.groupBy("toxic").count().collect()}
    u_toxic, u_clean = used.get(1, 0), used.get(0, 0)
    if not u_toxic or not u_clean:
        return ToxicityModel(base=1.0 if u_toxic else 0.0)
    least = max(2, min(LEAST_TOXIC, u_toxic // 10))
    even = F.col("toxic") * (u_clean / max(u_toxic, 1))
    strong = (F.col("toxic") >= least) & (F.col("toxic") >= LEAST_PURITY * (F.col("toxic") + F.col("clean") * share[1] / share[0]))
    found = candidate_counts(sample).filter(strong & (even > F.col("clean"))).collect()
    terms = chosen_terms([Term(r["term"], r["stem"], r["toxic"], r["clean"]) for r in found])
    if not terms:
        return ToxicityModel(base=n_toxic / (n_toxic + n_clean))
    own = Automaton(terms)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_runs(batch, "text"):
                hits = find_hits(texts, own)
                edges = pa.array(np.searchsorted(hits.text, np.arange(len(texts) + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(edges, pa.array(x.astype(np.int32))) for x in (hits.term, hits.distance, hits.quoted, hits.near)]
                yield pa.RecordBatch.from_arrays(
                    [column(part, "toxic"), pa.array(hits.words.astype(np.int32)), *lists],
                    names=["toxic", "words", "term", "distance", "quoted", "near"],
                )

    kinds = "toxic int, words int, term array<int>, distance array<int>, quoted array<int>, near array<int>"
    rows = sample.mapInArrow(searched, kinds).toPandas()
    labels = rows["toxic"].to_numpy(float)
    counts = np.zeros((2, 2 * len(terms)))  # by label; exact hits, then misspelled ones
    for label, term, distance in zip(rows["toxic"], rows["term"], rows["distance"], strict=True):
        counts[label, np.unique(np.asarray(term, int) + len(terms) * (np.asarray(distance, int) > 0))] += 1
    seen = []
    for r in rows.itertuples():
        term = np.asarray(r.term, dtype=int)
        off = np.asarray(r.distance, int) > 0
        own_counts = counts[:, term + len(terms) * off]
        others = term_weight(own_counts[1] - (r.toxic == 1), own_counts[0] - (r.toxic == 0), u_toxic, u_clean, off)
        seen.append(features(term, np.asarray(r.distance, int), np.asarray(r.quoted, bool), np.asarray(r.near, int), r.words, others))
    order = np.lexsort(np.array(seen).T)  # rows come in any order; sums should not depend on it
    x, y = np.array(seen)[order], labels[order]
    beta = logistic(x, y, np.where(y == 1, 1 / share[1], 1 / share[0]))
    both = counts.reshape(2, 2, -1)
    weights = term_weight(both[1], both[0], u_toxic, u_clean, np.array([[0], [1]]))
    return ToxicityModel(terms, weights, beta, n_toxic / (n_toxic + n_clean), own)


def judge(docs: DataFrame, model: ToxicityModel, keep: list[str | Column] | None = None, text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """The chosen columns of each row, or all, with `score` (0 to 1) and `predicted` (1 from the threshold on)."""

    def judged(texts: list[str | None]) -> list[pa.Array]:
        claim("toxicity", model.own and model.own.clear)
        scores = model.scores(texts)
        return [pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())]

    return with_new_columns(docs, keep, text, [("score", "double"), ("predicted", "integer")], judged)
