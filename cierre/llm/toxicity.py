"""Toxicity scores from a lexicon met by Levenshtein automata.

The lexicon is learnt: terms (words, and stems written ``stem*``) that occur
in toxic documents far more often than chance allows and hardly in others. The
bars follow from the sample's size, its share of toxic documents and the number
of terms tested; terms over the lower bar alone are weak and count apart.
It is kept as a trie. Each distinct word of a text becomes a Levenshtein
automaton, and the automaton and the trie are walked together: branches where
no state within the allowed distance is left are cut, so a misspelled term is
found without trying any other.

A hit counts with the weight of its term and distance, and by its context
window: inside quotation marks, or next to a word that reports speech, it is
taken as quoted, which weighs apart from abuse. A logistic curve over the
document's hits gives the score; its weights are learnt too, with a prior for
kinds of hits that the sample lacks.

The fit takes at most ``SAMPLE`` labelled documents, one of those that are
near copies with the same label; the lexicon has at most ``TERMS`` terms. Every document is scored.

Defined results: a null or empty text has no hits and a score like any other;
held_out is false and doc_id null for a null id; without labels of both kinds
every score is 0; repeated rows are scored each; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.llm import exchange as X
from cierre.llm import learn
from cierre.llm.ship import give_back, ship
from cierre.session import cut_lineage

HELD_OUT_MOD = 5
SAMPLE = 10_000
TERMS = 2000
THRESHOLD = 0.5
#: Strong terms: the chance that any of the tested ones is there by accident. Weak terms: the share
#: of accidents among them. Both need to be this much likelier in toxic documents.
ACCIDENT = 0.01
ACCIDENTS = 0.25
LIFT = 8.0
#: Weak terms' weight in the score is learnt on documents that did not choose them, in so many parts.
FOLDS = 10
#: A stem needs this many times the toxic documents of its most frequent word.
SPREAD = 1.5
STEM = range(4, 11)
WINDOW = 4
#: Letters, with digits and signs inside that stand for letters, and inner apostrophes.
WORD = regex.compile(r"[\p{L}\p{M}\p{N}@$]+(?:['’*][\p{L}\p{M}\p{N}]+)*")
QUOTES = "\"“”„«»‘"
_QUOTE = regex.compile(f"[{QUOTES}]")
#: Words that report speech (a fixed list; English, German, French, Spanish).
REPORTING = frozenset(
    "said says say called calls quoted quote quotes wrote writes word term insult insulted slur "
    "sagte nannte zitierte schrieb wort dit disait appelle cite mot dijo llama escribe palabra".split())
#: Signs that are written for letters (fixed values).
LOOKALIKE = str.maketrans("013457@$", "oieastas")
_REMEMBERED = 200_000
#: Near copies: this share of their min-hashes agrees. Rows that agree in a whole band are compared.
NEAR = 0.8
HASHES, BAND = 256, 8
_MIX = np.random.default_rng(7).integers(0, 1 << 64, (2, HASHES), np.uint64) | np.uint64(1)


class Trie:
    """Terms with a weight; a stem's end accepts any ending."""

    __slots__ = ("next", "term", "weight", "stem", "length")

    def __init__(self):
        self.next, self.term, self.weight, self.stem, self.length = {}, None, 0.0, False, 0

    def add(self, term: str, weight: float) -> None:
        node, letters = self, term.rstrip("*")
        for c in letters:
            node = node.next.setdefault(c, Trie())
        if node.term is None or weight > node.weight:
            node.term, node.weight, node.stem, node.length = term, weight, term.endswith("*"), len(letters)


def allowed(length: int, stem: bool) -> int:
    """Edits that a term of this length may have."""
    return int(length >= (6 if stem else 5))


class Levenshtein:
    """The automaton of one word. A state is how many letters are read and how many
    edits were made; all its ways are open at once, as those of an automaton that is
    not made deterministic: for few edits most of them end after a letter or two."""

    __slots__ = ("word", "limit")

    def __init__(self, word: str, limit: int):
        self.word, self.limit = word, limit

    def edits(self, read: int, made: int, stem: bool) -> int | None:
        """Least edits if the term ends here; a stem leaves the word's rest free."""
        made += 0 if stem else len(self.word) - read
        return made if made <= self.limit else None

    def walk(self, root: Trie) -> Iterator[tuple[Trie, int]]:
        """The intersection with a trie: (node with a term, edits), by depth first."""
        word, limit, size = self.word, self.limit, len(self.word)
        stack = [(root, 0, 0)]
        while stack:
            node, read, made = stack.pop()
            if node.term is not None:
                edits = self.edits(read, made, node.stem)
                if edits is not None:
                    yield node, edits
            letter = word[read] if read < size else None
            child = node.next.get(letter)
            if child is not None:
                stack.append((child, read + 1, made))
            if made < limit:
                made += 1
                free, after = made < limit, word[read + 1] if read + 1 < size else None
                if letter is not None:
                    stack.append((node, read + 1, made))  # a letter added in the word
                # With no edit left, a state that neither ends a term nor goes on with the next letter is dead.
                for other, child in node.next.items():
                    ends = free or child.term is not None
                    if ends or letter in child.next:
                        stack.append((child, read, made))  # a letter left out
                    if letter is not None and other != letter and (ends or after in child.next):
                        stack.append((child, read + 1, made))  # another letter


def lookup(root: Trie, word: str, limit: int = 1) -> tuple[str, float, int] | None:
    """The best term for a word: (term, weight, edits), the fewest edits first."""
    best = None
    for node, edits in Levenshtein(word, limit).walk(root):
        if edits <= allowed(node.length, node.stem):
            rank = (edits, -node.weight, node.term)
            if best is None or rank < best:
                best = rank
    return (best[2], -best[1], best[0]) if best else None


class Lexicon:
    """Terms, and a word's best term; words are remembered within a worker."""

    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.clear()

    def clear(self) -> None:
        self.root, self.known, self.tokens = Trie(), {}, {}
        exact, starts, heads, tails, inner = set(), {}, {}, {}, {}
        for term, weight in self.terms.items():
            self.root.add(term, weight)
            letters, stem = term.rstrip("*"), term.endswith("*")
            size, half = len(letters), len(letters) // 2
            if not allowed(size, stem):
                if stem:
                    starts.setdefault(size, set()).add(letters)
                else:
                    exact.add(letters)
                continue
            # One edit leaves the first or the second half as it is.
            first, second = letters[:half], letters[half:]
            if stem:
                starts.setdefault(half, set()).add(first)
                for at in (half - 1, half, half + 1):
                    inner.setdefault((at, at + size - half), set()).add(second)
            else:
                near = range(size - 1, size + 2)
                heads.setdefault(half, {}).setdefault(first, set()).update(near)
                tails.setdefault(half - size, {}).setdefault(second, set()).update(near)
        self.exact = exact
        self.starts, self.heads, self.tails, self.inner = (tuple(x.items()) for x in (starts, heads, tails, inner))

    def __getstate__(self):
        return self.terms

    def __setstate__(self, terms):
        self.terms = terms
        self.clear()

    def may_match(self, w: str) -> bool:
        """False only for words that no term is near enough to."""
        if w in self.exact:
            return True
        for n, found in self.starts:
            if w[:n] in found:
                return True
        size = len(w)
        for n, found in self.heads:
            if size in found.get(w[:n], ()):
                return True
        for n, found in self.tails:
            if size in found.get(w[n:], ()):
                return True
        for (a, b), found in self.inner:
            if w[a:b] in found:
                return True
        return False

    def holds(self, token: str) -> bool:
        """Whether what white space separates has a word that meets a term."""
        if token.isalpha():
            return self.find(token) is not None
        got = self.tokens.get(token)
        if got is None:
            if len(self.tokens) > _REMEMBERED:
                self.tokens.clear()
            got = any(self.find(w) for w in WORD.findall(token))
            if len(token) < 64:
                self.tokens[token] = got
        return got

    def hit(self, lows: list[str]) -> np.ndarray:
        """Of each lower-case text, whether it has a word that meets a term: each
        distinct token of all texts is looked up once."""
        parts = pc.utf8_split_whitespace(pa.array(lows, pa.string()))
        held, offsets = parts.flatten().dictionary_encode(), parts.offsets.to_numpy()
        met = np.fromiter(map(self.holds, held.dictionary.to_pylist()), bool, len(held.dictionary))
        before = np.concatenate([[0], np.cumsum(met[held.indices.to_numpy()])])
        return before[offsets[1:]] > before[offsets[:-1]]

    def find(self, word: str) -> tuple[str, float, int] | None:
        """The best term of a lower-case word, plainly written or with signs for letters."""
        if word in self.known:
            return self.known[word]
        if len(self.known) > _REMEMBERED:
            self.known.clear()
        got = lookup(self.root, word) if self.may_match(word) else None
        if (got is None or got[2]) and not word.isalpha():
            plain = word.translate(LOOKALIKE)
            if plain != word and self.may_match(plain):
                other = lookup(self.root, plain)
                if other and (got is None or other[2] < got[2]):
                    got = other
        if len(word) < 64:
            self.known[word] = got
        return got


def hits(text: str, lexicon: Lexicon) -> list[tuple[str, float, int, bool, int, int]]:
    """(term, weight, edits, quoted, start, end) of each hit in a text."""
    low = text.lower()
    if not lexicon.hit([low])[0]:
        return []
    return _hits(low, lexicon)


def _hits(low: str, lexicon: Lexicon) -> list[tuple[str, float, int, bool, int, int]]:
    out, marks, recent, at, line_end, last_mark = [], 0, [], 0, -1, -1
    for m in WORD.finditer(low):
        between = low[at : m.start()]
        if "\n" in between:
            marks = 0  # a quotation doesn't reach over a line
            between = between.rpartition("\n")[2]
        if between != " ":
            marks += len(_QUOTE.findall(between))
        at = m.end()
        w = m.group()
        got = lexicon.find(w)
        if got is not None:
            after = low[at : at + 80]
            if at > line_end:  # once for each line with a hit
                line_end = low.find("\n", at)
                line_end = len(low) if line_end < 0 else line_end
                last_mark = max(low.rfind(q, at, line_end) for q in QUOTES)
            closes = last_mark >= at
            near = recent[-WINDOW:] + WORD.findall(after)[:WINDOW]
            quoted = (marks % 2 == 1 and closes) or any(x in REPORTING for x in near)
            out.append((*got, quoted, m.start(), at))
        recent.append(w)
        del recent[:-WINDOW]
    return out


#: Figures of a document's hits: plain terms, misspelled ones, quoted ones, weak terms, constant.
PRIOR = np.array([2.2, 1.1, 0.3, 0.8, -1.6])


def figures(found: list, weak: frozenset[str] = frozenset()) -> np.ndarray:
    """Sums of weights, of different terms first: a term's repeats count less."""
    sums: list[dict[str, float]] = [{}, {}, {}, {}]
    for term, weight, edits, in_quotes, _, _ in found:
        part = sums[2 if in_quotes else 3 if term in weak else 1 if edits else 0]
        old = part.get(term)
        part[term] = weight if old is None else min(old + 0.5 * weight, 3 * weight)
    return np.array([*(sum(x.values()) for x in sums), 1.0])


class Model:
    def __init__(self, terms: dict[str, float], weights: np.ndarray = PRIOR, weak: frozenset[str] = frozenset()):
        self.lexicon, self.weights, self.weak = Lexicon(terms), weights, weak

    def score(self, text: str) -> float:
        return self.scores([text])[0]

    def scores(self, texts: list[str]) -> list[float]:
        """The score of each text."""
        lows = [t.lower() for t in texts]
        plain, out = self._score([]), []
        for low, met in zip(lows, self.lexicon.hit(lows).tolist()):
            out.append(self._score(_hits(low, self.lexicon)) if met else plain)
        return out

    def _score(self, found: list) -> float:
        return float(learn.sigmoid(figures(found, self.weak) @ self.weights))


def _terms_of(text: str) -> set[str]:
    words = {w for w in WORD.findall(text.lower()) if len(w) < 40}
    return words | {w[:n] + "*" for w in words for n in STEM if len(w) > n}


def signature(text: str) -> np.ndarray:
    """Min-hashes of a text's word pairs; their agreement estimates the pairs' Jaccard similarity."""
    words = text.lower().split()
    pairs = {f"{a} {b}" for a, b in zip(words, words[1:])} or {text}
    h = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in pairs), np.uint64, len(pairs))
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(h), 1024):
        mixed = ((h[k : k + 1024, None] ^ _MIX[0]) * _MIX[1]) >> np.uint64(32)
        out = np.minimum(out, mixed.min(axis=0).astype(np.uint32))
    return out


def distinct(rows: list[tuple[int, int, bytes]]) -> list[tuple[int, int]]:
    """(doc_id, label) of (doc_id, label, signature) without near copies: by doc_id, a row is
    left out if one with its label that stays is ``NEAR`` alike. Rows of different labels are
    never taken for one."""
    kept, prints, buckets = [], [], {}
    for doc_id, label, sig in sorted(rows, key=lambda r: r[:2]):
        lanes = np.frombuffer(sig, np.uint32)
        keys = [(label, n, sig[4 * BAND * n : 4 * BAND * (n + 1)]) for n in range(HASHES // BAND)]
        near = sorted({i for key in keys for i in buckets.get(key, ())})
        if near and max(np.mean(np.array([prints[i] for i in near]) == lanes, axis=1)) >= NEAR:
            continue
        for key in keys:
            buckets.setdefault(key, []).append(len(kept))
        kept.append((doc_id, label))
        prints.append(lanes)
    return kept


def tested(supports: list[tuple[int, int]], share: float) -> tuple[int, int]:
    """From (documents, terms that many hold): the least number of documents a term needs so that
    chance makes about five terms at most that only toxic documents hold, and the terms that have it."""
    least, n_terms = max((n for n, _ in supports), default=0) + 1, 0
    for n, terms in sorted(supports, reverse=True):
        if share**n * (n_terms + terms) > 5:
            break
        least, n_terms = n, n_terms + terms
    return least, n_terms


def chance(t: int, n: int, share: float) -> float:
    """That t or more of n documents are toxic, each with the probability ``share``."""
    def log_p(x):
        return (math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1)
                + x * math.log(share) + (n - x) * math.log1p(-share))
    return min(1.0, sum(math.exp(log_p(x)) for x in range(t, n + 1)))


def select(counts: list[tuple[str, int, int]], toxic: int, clean: int, n_terms: float,
           limit: int = TERMS) -> tuple[dict[str, float], frozenset[str]]:
    """Terms from (term, toxic documents, clean documents), and which of them are weak: those
    that chance does not explain among ``n_terms`` tested ones, the strongest first. A stem must
    have more than one word behind it, and stands for its words and for longer and shorter stems."""
    share, found, most = toxic / (toxic + clean), {}, Counter()
    for term, t, c in counts:
        if not term.endswith("*"):
            for n in STEM:
                if len(term) >= n:
                    most[term[:n] + "*"] = max(most[term[:n] + "*"], t)
    for term, t, c in counts:
        lift = (t / toxic) / ((c + 0.5) / (clean + 1))
        if t and lift >= LIFT and (not term.endswith("*") or t >= SPREAD * most[term]):
            found[term] = (chance(t, t + c, share), min(3.0, math.log(lift) / 2))
    # Benjamini and Hochberg's bar for the weak ones, Bonferroni's for the strong ones.
    ranked = sorted(p for p, _ in found.values())
    bar = max((p for k, p in enumerate(ranked, 1) if p * n_terms <= k * ACCIDENTS), default=-1.0)
    strong = {x for x, (p, _) in found.items() if p * n_terms <= ACCIDENT}
    kept: dict[str, float] = {}
    stems: list[str] = []
    for term in sorted((x for x in found if x in strong or found[x][0] <= bar),
                       key=lambda x: (x not in strong, found[x][0], -len(x), x)):
        letters = term.rstrip("*")
        if any(letters.startswith(x) for x in stems):
            continue
        if term.endswith("*"):
            if any(x.startswith(letters) for x in stems):
                continue
            stems.append(letters)
            for x in [x for x in kept if x.startswith(letters) and (term in strong or x not in strong)]:
                del kept[x]
        kept[term] = found[term][1]
    kept = dict(list(kept.items())[:limit])
    return kept, frozenset(kept.keys() - strong)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "toxic") -> Model | None:
    """Learn from the labelled documents that are not held out; None without both labels."""
    ship(docs.sparkSession)
    wanted = learn.labelled_ids(labels, label, HELD_OUT_MOD, sample)
    texts = learn.one_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(wanted), "doc_id"))  # bounded by `sample`

    def signed(batches):
        for batch in batches:
            yield X.record("doc_id long, label int, sig binary", batch.column(0), batch.column(1),
                           [signature(t).tobytes() for t in batch.column(2).to_pylist()])

    signatures = texts.select("doc_id", "label", "text").mapInArrow(signed, "doc_id long, label int, sig binary")
    rows = distinct([(r["doc_id"], r["label"], bytes(r["sig"])) for r in signatures.collect()])  # at most `sample` rows
    toxic, clean = sum(y == 1 for _, y in rows), sum(y != 1 for _, y in rows)
    if not toxic or not clean:
        return None
    rows.sort(key=lambda r: (r[1] == 1, r[0]))
    sizes = Counter((n % FOLDS, y == 1) for n, (_, y) in enumerate(rows))
    ids = docs.sparkSession.createDataFrame([(i, n % FOLDS) for n, (i, _) in enumerate(rows)], "doc_id long, part int")
    learnt = texts.join(F.broadcast(ids), "doc_id").select("text", (F.col("label") == 1).cast("int").alias("label"), "part")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tally: Counter = Counter()
            for text, mark, part in zip(*(x.to_pylist() for x in batch.columns)):
                tally.update((t, 2 * part + mark) for t in _terms_of(text))
            if tally:
                yield X.record("term string, cell int, n long", *zip(*((t, m, n) for (t, m), n in tally.items())))

    cells = [F.coalesce(F.sum(F.when(F.col("cell") == k, F.col("n"))), F.lit(0)) for k in range(2 * FOLDS)]
    tallied = cut_lineage(learnt.mapInArrow(count, "term string, cell int, n long").groupBy("term").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("cell") % 2 == 1, F.col("n"))), F.lit(0)).alias("t"),
        F.array(*cells).alias("cells")))
    supports = tallied.groupBy("n").count().collect()  # at most `sample` rows
    least, n_terms = tested([(r["n"], r["count"]) for r in supports], toxic / (toxic + clean))
    lift = (F.col("t") / toxic) / ((F.col("n") - F.col("t") + 0.5) / (clean + 1))
    # Bounded candidates; TERMS of them at most stay.
    likely = tallied.filter((F.col("n") >= least - 1) & (lift >= LIFT / 2)).orderBy(F.desc("t"), "term").limit(50 * TERMS).collect()
    terms, weak = select([(r["term"], r["t"], r["n"] - r["t"]) for r in likely if r["n"] >= least], toxic, clean, n_terms)
    # For each part, the terms that the other parts choose: chosen terms always fit their own documents.
    # A part that holds one of a term's documents must not lose the term by it, so the bars are one document lower.
    chosen = []
    for k in range(FOLDS):
        rest = [(r["term"], r["t"] - r["cells"][2 * k + 1], r["n"] - r["t"] - r["cells"][2 * k]) for r in likely]
        left = toxic - sizes[k, True], clean - sizes[k, False]
        chosen.append(select(rest, *left, n_terms * toxic / (toxic + clean)) if all(left) else ({}, frozenset()))
    lexicons = [(Lexicon(t), w) for t, w in chosen]

    def describe(batches):
        for batch in batches:
            lows, parts = [t.lower() for t in batch.column(0).to_pylist()], np.array(batch.column(2).to_pylist())
            x = [None] * len(lows)
            for k, (lexicon, few) in enumerate(lexicons):
                mine = np.flatnonzero(parts == k).tolist()
                for n, met in zip(mine, lexicon.hit([lows[n] for n in mine]).tolist() if mine else ()):
                    x[n] = figures(_hits(lows[n], lexicon) if met else [], few).tolist()
                lexicon.clear()
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])

    seen = learnt.mapInArrow(describe, "label int, x array<double>").collect()
    x, y = np.array([r["x"] for r in seen]), np.array([float(r["label"]) for r in seen])
    return Model(terms, _weights(x, y), weak)


def _weights(x: np.ndarray, y: np.ndarray, hold=np.array([2e-3, 2e-2, 2e-2, 2e-2, 2e-3])) -> np.ndarray:
    """Logistic regression held near ``PRIOR``, so that hits of a kind the sample
    lacks keep their prior weight; abuse never lowers a score."""
    w = PRIOR.copy()
    for _ in range(60):
        p = learn.sigmoid(x @ w)
        slope = x.T @ (p - y) / len(y) + hold * (w - PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(y) + np.diag(hold)
        step = np.linalg.solve(curve, slope)
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    w[:4] = np.maximum(w[:4], 0.0)
    return w


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    ship(docs.sparkSession)
    schema = "doc_id long, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                texts = [t or "" for t in part.column(1).to_pylist()]
                yield X.record(schema, part.column(0), model.scores(texts) if model else [0.0] * len(texts))
        if model:
            model.lexicon.clear()
        give_back()

    picked = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return picked.mapInArrow(run, schema).select(
        "doc_id", F.coalesce(learn.crc_mod(F.col("doc_id"), HELD_OUT_MOD) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under ``THRESHOLD``, with all their columns."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                if model is not None:
                    got = model.scores([t or "" for t in part.column(at).to_pylist()])
                    part = part.filter(pa.array([x < THRESHOLD for x in got], pa.bool_()))
                yield part
        if model:
            model.lexicon.clear()
        give_back()

    return docs.mapInArrow(run, docs.schema)


def found_terms(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each hit: doc_id, term, edits, quoted, and its place in the text (code points)."""
    ship(docs.sparkSession)
    schema = "doc_id long, term string, edits int, quoted boolean, start long, end long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, h[0], h[2], h[3], h[4], h[5]) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for h in hits(t or "", model.lexicon)]
            if rows:
                yield X.record(schema, *zip(*rows))

    picked = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return picked.mapInArrow(run, schema)
