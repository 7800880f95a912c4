"""Problem 5: score texts for abusive, hateful or sexual language, and report rates by source.

Method: a convolutional text classifier trained here in numpy. A token is folded (tags, width,
look-alikes, accents, invisible characters, digits and marks that stand for letters, repeated
letters) and embedded as the mean of hashed vectors of itself and its letter trigrams; filters of
three widths slide over a segment of tokens, the maximum of each filter is pooled, and a linear
layer gives the segment's score; a text has the score of its worst segment. Thresholds are set for
each language so that held-out cases in text of that language pass.

The classifier is fitted on a bounded sample (``TRAIN_TEXTS`` texts, chosen by a hash of the id, and
``TRAIN_LINES`` runs of words, spread over the whole of each): terms in many spellings are written into lines of it, against lines without any, lines with words
that merely contain a term, with parts of phrases and with terms of severity 1. Every text is
scored, whole. Texts that reach the threshold of their language are then checked for the terms
letter by letter; the others have no case. ``flagged`` is the verdict of the score alone, at the
threshold that separates held-out lines with a term from held-out lines without one best.

Defined cases: null texts have no score and are not reported; empty texts score lowest; null ids
are dropped; repeated deliveries give one id; without any term of severity 2 or 3 nothing is
reported; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
import unicodedata

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow
from .confusables import SHAPES
from .line_dedup import source_key
from .text_stats import guess_language

TRAIN_TEXTS, TRAIN_LINES, SEGMENT, OVERLAP = 1500, 12_000, 32, 6
BUCKETS, DIM, FILTERS, WIDTHS = 8192, 16, 16, (1, 2, 3)
MARGIN = 2.5
LEAST_STEPS = 350  # of training, however few the terms

#: Characters that stand for letters.
STANDS_FOR = {"a": "4@", "b": "8", "c": "(", "e": "3€", "g": "96", "i": "1!|", "l": "1!|", "o": "0", "q": "9", "s": "5$", "t": "7+", "z": "2"}
MASKS = "*#"
TAG = re.compile(r"</?[a-z][^<>]*>", re.IGNORECASE)
_LOOK = {ord(a): b for a, b in SHAPES.items()}
_LIKE = re.compile("[" + "".join(SHAPES) + "]")
_UNMARKED = re.compile("[" + "".join(chr(c) for c in range(0x80, 0x10000) if unicodedata.combining(chr(c)) or unicodedata.category(chr(c)) == "Cf" or 0xFE00 <= c <= 0xFE0F) + "]+")


def plain(text: str) -> str:
    """Lower-case text without mark-up, look-alikes, accents and invisible characters."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = TAG.sub("", text)
    if not text.isascii():
        text = _UNMARKED.sub("", unicodedata.normalize("NFKD", text))
        if _LIKE.search(text):
            text = text.translate(_LOOK)
    return text.lower().replace("\r\n", "\n")


# ---------------------------------------------------------------- letter by letter
#: What may stand between letters written apart.
APART = r"[ ._\-*·/|]"
GAP = r"(?:[ \t]{1,4}\n?[ \t]*|\n[ \t]*|[-_.])"


def term_pattern(terms: list[str]) -> re.Pattern | None:
    """Matches any of the terms or plurals as whole words in plain text, in any spelling seen as the same."""
    if not terms:
        return None

    def letter(c: str) -> str:
        return "[" + re.escape(c + STANDS_FOR.get(c, "") + MASKS) + "]" if c.isalnum() else re.escape(c)

    # alternatives are grouped by their first letter, so that a word is compared with few of them
    groups: dict[str, list[str]] = {}
    for term in sorted({plain(t).strip() for t in terms} - {""}):
        words = term.split()
        joined = GAP.join("".join(letter(c) + "+" for c in w) for w in words) + "(?:[e3]?[s5$]+)?"
        apart = GAP.join(APART.join(letter(c) for c in w) for w in words)
        first = letter(term[0])
        groups.setdefault(first, []).extend([first + "*" + joined[len(first) + 1 :], apart[len(first) :]])
    return re.compile(r"(?<![^\W_])(?:" + "|".join(f"{first}(?:{'|'.join(forms)})" for first, forms in groups.items()) + r")(?![^\W_])")


def holds_term(text: str, pattern: re.Pattern) -> bool:
    """Whether a plain text holds a term; no more than a third of its letters may be masked."""
    at = 0
    while m := pattern.search(text, at):
        found = m[0]
        masked = sum(found.count(c) for c in MASKS)
        if masked <= max(1, sum(c.isalnum() for c in found) // 2) and sum(c.isalpha() for c in found) >= 2 or not masked and re.search("[a-z]", found):
            return True
        at = m.start() + 1
    return False


# ---------------------------------------------------------------- tokens
SPACED = re.compile(rf"(?<![^\W_])(?:[^\W_]{APART}){{3,}}[^\W_](?![^\W_])")
TOKEN = re.compile(r"[^\s\-_./\"“”«»„,;:()\[\]]+")
_FOLD = str.maketrans({d: c for c, ds in STANDS_FOR.items() for d in ds} | {"1": "i", "!": "i", "|": "i", "l": "i", "9": "g", "#": "*"})
RUN = re.compile(r"(.)\1+")


def fold_token(token: str) -> str:
    """One form for all spellings of a token, masks apart."""
    token = token.rstrip("!?'’") or token
    return RUN.sub(r"\1", token.strip("?'’").translate(_FOLD))


def raw_tokens(text: str) -> list[str]:
    """Tokens of a plain text; letters written apart count as one token."""
    return TOKEN.findall(SPACED.sub(lambda m: re.sub(APART, "", m[0]), text))


def buckets(token: str) -> list[int]:
    """Hashed features of a folded token: itself and its letter trigrams."""
    padded = f"<{token}>"
    return [xxhash.xxh32_intdigest(x) % BUCKETS for x in dict.fromkeys([padded, *(padded[i : i + 3] for i in range(len(padded) - 2))])]


class Classifier:
    """Embedding, convolution, max pooling and a linear layer; scores are log-odds."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.p = {"H": rng.normal(0, 0.3, (BUCKETS, DIM)), "out": rng.normal(0, 0.3, FILTERS * len(WIDTHS)), "b": np.zeros(1)}
        for w in WIDTHS:
            self.p[f"W{w}"] = rng.normal(0, 1 / np.sqrt(w * DIM), (w * DIM, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.thresholds: dict[str, float] = {}
        self.verdict = 0.0

    def embed(self, tokens: list[str]) -> np.ndarray:
        return np.array([self.p["H"][buckets(t)].mean(axis=0) for t in tokens], np.float32).reshape(-1, DIM)

    def fit(self, windows: list[list[str]], labels: np.ndarray, epochs: int = 7, rate: float = 0.01) -> None:
        """Adam on the logistic loss; windows are lists of folded tokens."""
        names = sorted({t for w in windows for t in w})
        index = {t: i + 1 for i, t in enumerate(names)}
        lists = [buckets(t) for t in names]
        flat, starts = np.concatenate(lists), np.cumsum([0, *(len(x) for x in lists[:-1])])
        sizes = np.array([len(x) for x in lists], np.float32)[:, None]
        owner = np.repeat(np.arange(len(names)), sizes[:, 0].astype(int))
        length = max(max(map(len, windows)), max(WIDTHS))
        ids = np.zeros((len(windows), length), np.int64)
        for i, w in enumerate(windows):
            ids[i, : len(w)] = [index[t] for t in w]
        rng = np.random.default_rng(11)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, batches = 0, max(1, len(windows) // 128)
        for _ in range(max(epochs, -(-LEAST_STEPS // batches))):
            for batch in np.array_split(rng.permutation(len(windows)), batches):
                step += 1
                p, grad = self.p, {}
                E = np.concatenate([np.zeros((1, DIM), np.float32), np.add.reduceat(p["H"][flat], starts) / sizes])
                X = E[ids[batch]]
                pooled, kept = [], []
                for w in WIDTHS:
                    patch = np.concatenate([X[:, k : length - w + 1 + k] for k in range(w)], axis=2)
                    act = patch @ p[f"W{w}"] + p[f"b{w}"]
                    best = act.argmax(axis=1)
                    pooled.append(np.maximum(np.take_along_axis(act, best[:, None], axis=1)[:, 0], 0))
                    kept.append((patch, best))
                feats = np.concatenate(pooled, axis=1)
                err = ((1 / (1 + np.exp(-np.clip(feats @ p["out"] + p["b"], -30, 30))) - labels[batch]) / len(batch)).astype(np.float32)
                grad["out"], grad["b"] = feats.T @ err + 1e-4 * p["out"], err.sum(keepdims=True)
                dX = np.zeros_like(X)
                for n, w in enumerate(WIDTHS):
                    patch, best = kept[n]
                    g = err[:, None] * p["out"][n * FILTERS : (n + 1) * FILTERS] * (pooled[n] > 0)
                    chosen = np.take_along_axis(patch, best[:, :, None], axis=1)  # window, filter, w * DIM
                    grad[f"W{w}"], grad[f"b{w}"] = np.einsum("bfd,bf->df", chosen, g), g.sum(axis=0)
                    back = g[:, :, None] * p[f"W{w}"].T[None]
                    for k in range(w):
                        np.add.at(dX, (np.arange(len(batch))[:, None], best + k), back[:, :, k * DIM : (k + 1) * DIM])
                dE = np.zeros_like(E)
                np.add.at(dE, ids[batch].ravel(), dX.reshape(-1, DIM))
                grad["H"] = np.zeros_like(p["H"])
                np.add.at(grad["H"], flat, (dE[1:] / sizes)[owner])
                for k, g in grad.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.99 * v2[k] + 0.01 * g * g
                    p[k] = (p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)


class Scorer:
    """A classifier with the filters of every token seen so far, used within a task."""

    def __init__(self, model: Classifier):
        self.model, self.width = model, FILTERS * sum(WIDTHS)
        self.kernel = np.concatenate([model.p[f"W{w}"][k * DIM : (k + 1) * DIM] for w in WIDTHS for k in range(w)], axis=1)
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {"": 0}  # the empty token, all zeros
        self.rows = np.zeros((1024, self.width), np.float32)

    def _known(self, tokens: list[str]) -> np.ndarray:
        distinct = set(tokens)
        if new := sorted(distinct - self.ids.keys()):
            if len(self.ids) + len(new) > 150_000:
                self.clear()
                new = sorted(distinct - {""})
            at = len(self.ids)
            while len(self.rows) < at + len(new):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[at : at + len(new)] = self.model.embed([fold_token(t) for t in new]) @ self.kernel
            self.ids.update((t, at + i) for i, t in enumerate(new))
        return np.fromiter(map(self.ids.__getitem__, tokens), np.int64, len(tokens))

    def scores(self, texts: list[list[str]]) -> np.ndarray:
        """The score of each text: that of its worst segment; -30 for texts without tokens."""
        out = np.full(len(texts), -30.0)
        a = 0
        while a < len(texts):
            b, size = a, 0
            while b < len(texts) and (b == a or size + len(texts[b]) < 60_000):
                size += len(texts[b])
                b += 1
            out[a:b] = self._scores(texts[a:b])
            a = b
        return out

    def _scores(self, texts: list[list[str]]) -> np.ndarray:
        pad = max(WIDTHS) - 1
        ids = self._known([t for text in texts for t in text])
        n = np.array([len(t) for t in texts])
        # every text is followed by `pad` empty tokens, so that no filter reaches into the next text
        begin = np.cumsum(n + pad) - (n + pad)
        total = len(ids) + pad * len(texts)
        padded = np.zeros(total + pad + 1, np.int64)
        padded[np.arange(len(ids)) + np.repeat(begin - (np.cumsum(n) - n), n)] = ids
        seg_from, seg_to, owner = [], [], []
        for i, (s, m) in enumerate(zip(begin.tolist(), n.tolist())):
            for k in range(0, max(1, m - OVERLAP), SEGMENT - OVERLAP) if m else ():
                seg_from.append(s + k)
                seg_to.append(s + min(m, k + SEGMENT))
                owner.append(i)
        out = np.full(len(texts), -30.0)
        if owner:
            bounds = np.stack([seg_from, seg_to], axis=1).ravel()
            pooled, col = [], 0
            for w in WIDTHS:
                act = self.rows[padded[: total + 1], col : col + FILTERS]
                for k in range(1, w):
                    act += self.rows[padded[k : total + 1 + k], col + k * FILTERS : col + (k + 1) * FILTERS]
                pooled.append(np.maximum(np.maximum.reduceat(act, bounds, axis=0)[::2] + self.model.p[f"b{w}"], 0))
                col += w * FILTERS
            np.maximum.at(out, owner, np.concatenate(pooled, axis=1) @ self.model.p["out"] + self.model.p["b"][0])
        return out


# ---------------------------------------------------------------- training
def spellings(term: str, rng: np.random.Generator) -> list[str]:
    """Ways to write a term, by kind, each kind with random places."""
    letters = [i for i, c in enumerate(term) if c.isalpha()]
    odd = [i for i in letters if term[i] in STANDS_FOR]
    out = [term, term.upper(), term.capitalize(), term + "s", re.sub(" ", "-", term), re.sub(" ", "_", term), re.sub(" ", "  ", term)]
    for share in (1.0, 0.7, 0.4):
        out.append("".join(STANDS_FOR[c][rng.integers(len(STANDS_FOR[c]))] if i in odd and rng.random() < share else c for i, c in enumerate(term)))
    for i in letters:
        out.append(term[:i] + MASKS[rng.integers(2)] + term[i + 1 :])
        out.append(term[:i] + term[i] * int(rng.integers(2, 6)) + term[i + 1 :])
    # letters apart, by each mark; of several words each by itself
    out += [" ".join(s.join(w) for w in term.split()) for s in " .-_*·/|"] + ["a " + " ".join(term)]
    return out


def train(texts: list[str], terms: list[str], mild: list[str], seed: int = 3) -> Classifier:
    """A classifier for ``terms``, calibrated by language; ``texts`` is the bounded sample."""
    rng = np.random.default_rng(seed)
    pattern = term_pattern(terms)
    terms = sorted({plain(t).strip() for t in terms} - {""})
    lines: list[tuple[str, list[str]]] = []
    for text in texts:
        clean = plain(text)
        language = guess_language(clean)
        words = clean.split()
        starts = list(range(0, len(words), 22))
        for k in rng.permutation(starts)[: max(1, TRAIN_LINES // max(1, len(texts)))].tolist() if starts else ():
            piece = words[k : k + 22]
            if not holds_term(" ".join(piece), pattern):
                lines.append((language, piece))
    if not lines:
        lines = [("und", ["the", "sea", "was", "calm"])]

    def written(extra: str, k: int | None = None) -> tuple[str, list[str]]:
        language, words = lines[rng.integers(len(lines)) if k is None else k % len(lines)]
        at = int(rng.integers(len(words) + 1))
        quoted = extra if rng.random() < 0.5 else f'"{extra}!"' if rng.random() < 0.5 else f"{extra},"
        return language, [fold_token(t) for t in raw_tokens(plain(" ".join([*words[:at], quoted, *words[at:]])))][:SEGMENT]

    cases = [written(s) for t in terms for s in spellings(t, rng)]
    cases += [written(t if rng.random() < 0.6 else t.upper()) for t in terms for _ in range(12)]
    alphabet = "abcdefghiklmnoprstuvw"
    affix = lambda n: "".join(alphabet[i] for i in rng.integers(len(alphabet), size=n))
    decoys = [x for t in terms for x in (affix(3) + t, t + affix(4), affix(2) + t + affix(3), affix(4) + t, *t.split()[: -1 if " " in t else 0], *t.split()[1:])]
    others = [written(x) for x in decoys + mild * 6 if not holds_term(plain(x), pattern)]
    others += [(lang, [fold_token(t) for t in raw_tokens(" ".join(w))][:SEGMENT]) for lang, w in (lines[i] for i in rng.permutation(len(lines))[: 3 * len(cases)])]
    windows = [w or [""] for _, w in cases + others]
    model = Classifier(seed)
    model.fit(windows, np.r_[np.ones(len(cases)), np.zeros(len(others))].astype(np.float32))
    # thresholds: fresh spellings in lines of each language
    held = [written(s) for t in terms for s in spellings(t, rng)]
    score = Scorer(model)
    lowest = {}
    for language in sorted({lang for lang, _ in lines}) + ["und"]:
        own = [k for k, (lang, _) in enumerate(lines) if lang == language] or range(len(lines))
        tried = [[t for t in written(s, own[i % len(own)])[1]] for t in terms for i, s in enumerate(spellings(t, rng))]
        lowest[language] = float(np.quantile(score.scores(tried), 0.002))
    held_scores = score.scores([w for _, w in held])
    floor = float(np.quantile(held_scores, 0.002))
    # the verdict of the score alone: fewest errors on lines that took no part in the training
    plain_lines = [[fold_token(t) for t in raw_tokens(" ".join(w))][:SEGMENT] for _, w in (lines[i] for i in rng.permutation(len(lines))[: 2 * len(held)])]
    clean = np.sort(score.scores(plain_lines + [w for _, w in (written(x) for x in decoys) if w]))
    cuts = np.quantile(np.concatenate([held_scores, clean]), np.linspace(0, 1, 400))
    errors = [(held_scores < c).mean() + 3 * (clean >= c).mean() for c in cuts]  # a text has many lines, so a false alarm weighs more
    model.verdict = float(cuts[int(np.argmin(errors))])
    model.thresholds = {k: min(v, floor) - MARGIN for k, v in lowest.items()} | {"": min(floor, *lowest.values()) - MARGIN}
    return model


def _fitted(df: DataFrame, id_col: str, text: str, terms: DataFrame) -> tuple[Classifier | None, list[str]]:
    rows = terms.select("term", "severity").filter("term IS NOT NULL").collect()  # a word list, 44 fixed rows
    strong = [r.term for r in rows if (r.severity or 0) >= 2]
    if not strong:
        return None, []
    hashed = df.select(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30)).alias("h"), F.col(text).alias("text"))
    # only about as many rows as are wanted come to the sort, so that a task sends its share and no more
    rate = min(1.0, 1.3 * TRAIN_TEXTS / max(1, df.select(id_col).count()))
    sample = hashed.filter((F.col("h") <= int(rate * (1 << 30))) & F.col("text").isNotNull()).orderBy("h", "text").limit(TRAIN_TEXTS)
    return train([r.text for r in sample.collect()], strong, [r.term for r in rows if (r.severity or 0) < 2]), strong  # bounded by TRAIN_TEXTS


def scored(df: DataFrame, terms: DataFrame, id_col: str = "id", text: str = "text", source: str | None = "source_archive", all_languages: bool = True) -> DataFrame:
    """(id, source, language, score, flagged, candidate, unsafe) of every row with a text.

    ``score`` is the classifier's, ``flagged`` its verdict, ``language`` a guess (without ``all_languages`` only for texts that may
    be candidates), ``candidate`` tells whether it reaches the threshold of the
    language, ``unsafe`` whether the candidate holds a term.
    """
    rows = df.select(F.col(id_col).cast("string").alias("id"), (source_key(F.col(source)) if source else F.lit(None).cast("string")).alias("source"), F.col(text).alias("text")).filter(F.col("id").isNotNull() & F.col("text").isNotNull())
    schema = "id string, source string, language string, score double, flagged boolean, candidate boolean, unsafe boolean"
    model, strong = _fitted(df, id_col, text, terms)
    if model is None:
        return rows.select("id", "source", F.lit("und").alias("language"), F.lit(-30.0).alias("score"), F.lit(False).alias("flagged"), F.lit(False).alias("candidate"), F.lit(False).alias("unsafe"))
    shared = df.sparkSession.sparkContext.broadcast(model)  # under 1 MB, by its fixed sizes
    held: list = []

    def work(cols: dict) -> dict:
        if not held:
            held.extend([Scorer(shared.value), term_pattern(strong)])
        texts = [plain(t) for t in cols["text"].to_pylist()]
        score = held[0].scores([raw_tokens(t) for t in texts])
        limits = shared.value.thresholds
        lowest = min(limits.values())
        language = [guess_language(t) if all_languages or s >= lowest else None for s, t in zip(score, texts)]
        candidate = [bool(s >= limits.get(lang, limits[""])) for s, lang in zip(score, language)]
        unsafe = [c and holds_term(t, held[1]) for c, t in zip(candidate, texts)]
        return {"id": cols["id"], "source": cols["source"], "language": language, "score": score, "flagged": score >= shared.value.verdict, "candidate": candidate, "unsafe": unsafe}

    return map_arrow(rows, ["id", "source", "text"], schema, work)


def unsafe_ids(df: DataFrame, terms: DataFrame, **options) -> DataFrame:
    """Ids of the texts that hold a term of severity 2 or 3."""
    return scored(df, terms, all_languages=False, **options).filter("unsafe").select("id").distinct()


def rates(df: DataFrame, terms: DataFrame, **options) -> DataFrame:
    """(source, n_docs, n_unsafe, rate, mean_score) by source; null is the row of texts without a source."""
    one = scored(df, terms, **options).groupBy("id", "source").agg(F.max("unsafe").alias("unsafe"), F.max("score").alias("score"))
    return one.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if("unsafe").alias("n_unsafe"), F.avg(F.col("unsafe").cast("double")).alias("rate"), F.avg("score").alias("mean_score"))
