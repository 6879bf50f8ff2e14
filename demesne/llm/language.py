"""Missing or wrong document language labels; languages mixed within a document.

Nearest-centroid classification. A sentence is the normalised TF-IDF vector of its hashed character
trigrams (with word ends) and whole words. Every language has several centroids. The labelled sentences
are clustered first, whatever their labels (spherical k-means); the clusters are named by the labels in
them, with how often each language is labelled as which estimated along with it by
expectation-maximization, so that wrong labels, however many a rare language has, do not outvote the
right ones. Round by round the
languages then take in the sentences that they tell clearly; last, the sentences of each language are
clustered again, which gives its centroids. A sentence takes the language of the nearest centroid by
cosine, and none if it lies further away than nearly all held-out sentences of that language do from
centroids learned without them (two halves, crossed), which does not depend on how many there are.

The document frequencies come from all documents, in one pass that leaves at most `dims` numbers. The
centroids are fitted on the driver on a bounded sample: of each language that labels name, at most about
`sample` documents, drawn by a hash of doc_id, and of each at most `per_document` sentences, drawn by place. A
sentence drawn more than once is learned once. Drawing is by row, so a frequent sentence is never lost.
Classification is one pass over all documents without a shuffle.

Segments. Rejected sentences (names, numbers) and those of less than three words, if there are longer
ones, neither make nor break a run. A run of one
sentence counts only if its language leads the neighbours' language by `margin`. The confidence of a
segment is the mean, by letters, of best / (best + second best language); that of a text is the mean over
what is in its language.

Defined results. Null, empty and letterless texts are no cases; so are texts all of whose sentences are
rejected. Mark-up is what stands between < and > on one line, a tag name first. A quotation of up to 40 characters is
no language of its own, a longer one is text. A label is read without case, blanks and region; one that names
no language counts as missing. Long texts are read whole. An empty table gives no rows. A language that no
cluster is named after (too few or no labelled sentences) gets its function words as its centroid.
With only some dozens of sentences of a language its centroids are weak. Extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANGUAGES = ("en", "cy", "fr", "de", "es", "pt", "pl")

#: ISO 639 codes and names of the languages, in English and their own.
NAMES = {
    "en": ("en", "eng", "english"),
    "cy": ("cy", "cym", "wel", "welsh", "cymraeg"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "es": ("es", "spa", "spanish", "español", "espanol", "castellano"),
    "pt": ("pt", "por", "portuguese", "português", "portugues"),
    "pl": ("pl", "pol", "polish", "polski"),
}
_CODE = {name: code for code, names in NAMES.items() for name in names}

#: Frequent function words of each language; they stand in for one of which no labelled sentences are at hand.
ANCHORS = {
    "en": "the of and to in that is was for with on by from this which not are be have has",
    "cy": "yr y yn a ac i o ar gan wedi mae bydd nid oes hon hwn neu cyn ei am",
    "fr": "le la les des du et est une dans que pour par sur avec au aux cette ne pas été",
    "de": "der die das und ist ein eine den dem mit von für auf nicht zu im wird sich auch bei",
    "es": "el la los las de del y en que por con una para se al su es ha como no",
    "pt": "o a os as do da dos das em que por com uma para se ao no na não foi",
    "pl": "w i na z do nie się jest że od przez oraz dnia po przy o za dla są był",
}

_END = re.compile(r"(?<=[.!?])[\"')\]»”]*\s+|\n\s*\n+")
_MARKUP = re.compile(r"</?[A-Za-z!][^<>\n]*>|^>+ ?", re.M)
_QUOTED = re.compile(r"[\"“„«][^\"“”„«»]{1,40}[\"”»]")


def language_of_label(label: str | None) -> str | None:
    """The code of the language a label names; None if it names none of them."""
    if not label:
        return None
    return _CODE.get(re.split(r"[-_\s(.]", label.strip().lower(), maxsplit=1)[0])


def _ends_in_initial(s: str) -> bool:
    """The text ends in a full stop after a letter that stands alone."""
    return len(s) > 1 and s[-1] == "." and s[-2].isalpha() and (len(s) == 2 or s[-3].isspace() or s[-3] in "(>")


def sentences(text: str | None) -> list[str]:
    """Sentences in order. A full stop after a single letter (an initial) ends none; lone line breaks are layout."""
    if not text:
        return []
    if "<" in text or ">" in text:
        text = html.unescape(_MARKUP.sub(" ", text))
    out: list[str] = []
    for part in _END.split(text):
        part = part.strip()
        if not part:
            continue
        if out and _ends_in_initial(out[-1]):
            out[-1] = f"{out[-1]} {part}"
        else:
            out.append(part)
    return out


# ---------------------------------------------------------------- vectors

_LETTERS: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Code point to its lower-case letter, to a blank if it is none, to itself if it is an apostrophe or line break."""
    if not _LETTERS:
        t = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                t[c] = ord(low) if len(low) == 1 else c
        t[10] = 10
        _LETTERS.append(t)
    return _LETTERS[0]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(letters and blanks of all texts, text number of each); texts are set apart by line breaks, quoted words left out."""
    clean = [_QUOTED.sub(" ", t) if '"' in t or "\u201c" in t or "\u201d" in t or "\u201e" in t or "\u00ab" in t else t for t in texts]
    joined = " " + " \n ".join(t.replace("\n", " ") for t in clean) + " "
    cp = _letter_table()[np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)]
    return cp, np.cumsum(cp == 10)


def letter_counts(texts: list[str]) -> np.ndarray:
    """Letters of each text, quoted words included."""
    joined = "\n".join(t.replace("\n", " ") for t in texts)
    cp = _letter_table()[np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)]
    return np.bincount(np.cumsum(cp == 10)[cp > 32], minlength=len(texts)) if len(cp) else np.zeros(len(texts), np.int64)


_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xCA5A826395121157)


def _grams(texts: list[str], dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text of each letter, feature of the trigram around it, first letter of each word, 64-bit hash of each word).

    A trigram has a letter in the middle; a blank at an end says where a word begins or ends.
    """
    letters, row = code_points(texts)
    mid = np.flatnonzero(letters > 32)
    cp = letters.astype(np.uint64)
    bits = np.uint64(64 - (dims.bit_length() - 1))
    tri = ((cp[mid - 1] * _M1 + cp[mid] * _M2 + cp[mid + 1] * _M3) * _M1 >> bits).astype(np.int64)
    begin = np.flatnonzero(letters[mid - 1] <= 32)
    if not len(mid):
        return row[mid], tri, begin, np.empty(0, np.uint64)
    # a word is a polynomial of its letters
    place = np.arange(len(mid)) - np.repeat(begin, np.diff(np.r_[begin, len(mid)]))
    power = np.cumprod(np.full(int(place.max()) + 1, _M2, np.uint64))
    return row[mid], tri, begin, np.add.reduceat(cp[mid] * power[place], begin) * _M3


def _word_features(word: np.ndarray, dims: int) -> np.ndarray:
    return (word >> np.uint64(64 - (dims.bit_length() - 1))).astype(np.int64)


def features(texts: list[str], dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, count) of every trigram and word, sorted by row and feature; dims is a power of two."""
    if not texts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    row, tri, begin, word = _grams(texts, dims)
    return _counted(row, tri, begin, word, dims)


def _counted(row: np.ndarray, tri: np.ndarray, begin: np.ndarray, word: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    shift = np.int64(dims.bit_length() - 1)
    key = np.concatenate([(row << shift) | tri, (row[begin] << shift) | _word_features(word, dims)])
    key.sort()
    first = np.flatnonzero(np.r_[len(key) > 0, key[1:] != key[:-1]])
    count = np.diff(np.r_[first, len(key)])
    key = key[first]
    return key >> shift, key & np.int64(dims - 1), count


def vectors(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, weight): TF-IDF with unit length per row."""
    row, col, count = features(texts, len(idf))
    w = (count * idf[col]).astype(np.float32)
    norm = np.sqrt(np.bincount(row, w * w, minlength=len(texts)))
    return row, col, w / np.maximum(norm[row], 1e-12).astype(np.float32)


def similarities(sparse: tuple[np.ndarray, np.ndarray, np.ndarray], n: int, centroids: np.ndarray) -> np.ndarray:
    """(rows, centroids) cosines; centroids is (features, centroids)."""
    row, col, w = sparse
    out = np.zeros((n, centroids.shape[1]), np.float32)
    centroids = centroids.astype(np.float32, copy=False)
    for k in range(0, len(row), 500_000):
        r, c, x = row[k : k + 500_000], col[k : k + 500_000], w[k : k + 500_000]
        first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]]) if len(r) else np.empty(0, int)
        if len(first):
            out[r[first]] += np.add.reduceat(centroids[c] * x[:, None], first, axis=0)
    return out


# ---------------------------------------------------------------- model


class Model:
    def __init__(self, idf: np.ndarray, centroids: np.ndarray, owner: np.ndarray, reject: np.ndarray) -> None:
        self.idf, self.centroids, self.owner, self.reject = idf, centroids.astype(np.float32), owner, reject
        self.weighted: np.ndarray | None = None

    def cosines(self, texts: list[str]) -> np.ndarray:
        """(texts, centroids). A dot product is a sum over words, so each distinct word is multiplied out once."""
        dims, out = len(self.idf), np.zeros((len(texts), self.centroids.shape[1]), np.float32)
        if not texts:
            return out
        row, tri, begin, word = _grams(texts, dims)
        if not len(word):
            return out
        one, count = self._weighted(), np.diff(np.r_[begin, len(tri)])
        _, first, at = np.unique(word, return_index=True, return_inverse=True)
        size = count[first]
        inside = np.repeat(begin[first] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(int(size.sum()))
        product = np.add.reduceat(one[tri[inside]], np.r_[0, np.cumsum(size)[:-1]], axis=0) + one[_word_features(word[first], dims)]
        r = row[begin]
        start = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        out[r[start]] = np.add.reduceat(product[at], start, axis=0)
        rows, col, n = _counted(row, tri, begin, word, dims)
        norm = np.sqrt(np.bincount(rows, (n * self.idf[col]) ** 2, minlength=len(texts)))
        return out / np.maximum(norm, 1e-12).astype(np.float32)[:, None]

    def _weighted(self) -> np.ndarray:
        if self.weighted is None:
            self.weighted = self.centroids * self.idf[:, None].astype(np.float32)
        return self.weighted

    def classify(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(language number or -1, cosine with the nearest centroid of each language)."""
        sims = self.cosines(texts)
        by = np.stack([sims[:, self.owner == k].max(axis=1) if (self.owner == k).any() else np.full(len(texts), -1.0) for k in range(len(LANGUAGES))], axis=1)
        best = by.argmax(axis=1)
        near = by[np.arange(len(texts)), best]
        return np.where(near >= self.reject[best], best, -1), by


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.sqrt((m * m).sum(axis=0, keepdims=True)), 1e-12)


def _means(sparse: tuple[np.ndarray, np.ndarray, np.ndarray], group: np.ndarray, groups: int, dims: int) -> np.ndarray:
    row, col, w = sparse
    g = group[row]
    ok = g >= 0
    return np.bincount(col[ok] * groups + g[ok], w[ok], minlength=dims * groups).reshape(dims, groups)


def _rows(sparse: tuple[np.ndarray, np.ndarray, np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """These rows (in rising order), numbered anew."""
    row, col, w = sparse
    lo, hi = np.searchsorted(row, rows, "left"), np.searchsorted(row, rows, "right")
    size = hi - lo
    at = np.repeat(lo - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(int(size.sum()))
    return np.repeat(np.arange(len(rows)), size), col[at], w[at]


def _cluster(sparse: tuple[np.ndarray, np.ndarray, np.ndarray], n: int, dims: int, k: int, rounds: int, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(group of each row, centroids (features, groups)) by spherical k-means; empty groups are dropped.

    The first centroids are rows drawn (the same at every run) with the square of their distance from those before.
    """
    row, col, w = sparse
    begin = np.searchsorted(row, np.arange(n + 1))
    near, seeds, at, rnd = np.full(n, -1.0), [], int(n // 2), np.random.default_rng(n)
    for _ in range(min(k, n)):
        seeds.append(at)
        one = np.zeros(dims, np.float32)
        one[col[begin[at] : begin[at + 1]]] = w[begin[at] : begin[at + 1]]
        near = np.maximum(near, np.bincount(row, one[col] * w, minlength=n))
        far = np.cumsum((1 - np.minimum(near, 1)) ** 2)
        at = min(int(np.searchsorted(far, rnd.random() * far[-1], "right")), n - 1)
    centre = np.zeros((dims, len(seeds)), np.float32)
    for j, i in enumerate(seeds):
        centre[col[begin[i] : begin[i + 1]], j] = w[begin[i] : begin[i + 1]]
    group = np.full(n, -1)
    for _ in range(rounds):
        now = similarities(sparse, n, centre).argmax(axis=1)
        if (now == group).all():
            break
        _, group = np.unique(now, return_inverse=True)
        centre = _unit(_means(sparse, group, int(group.max()) + 1, dims))
        group = now if len(np.unique(now)) == centre.shape[1] and now.max() < centre.shape[1] else group
    return group, centre


def _named(held: np.ndarray, rates: np.ndarray, right: float = 0.7, strength: float = 50.0, rounds: int = 30, sure: float = 0.9) -> np.ndarray:
    """The language of each cluster from the labels drawn in it, -1 where they do not tell.

    Expectation-maximization: how often each language is labelled as which is estimated together with the
    languages of the clusters. It starts from `right` of a language's sentences having its label and the others
    any label, as frequent as that label is; `rates` are the shares drawn of each label.
    """
    n = held.shape[1]
    volume = held.sum(axis=0) / rates
    start = rates * (right * np.eye(n) + (1 - right) * volume / max(volume.sum(), 1))
    start /= start.sum(axis=1, keepdims=True)
    confusion, prior, post = start, np.full(n, 1 / n), np.zeros((len(held), n))
    for _ in range(rounds):
        log = held @ np.log(confusion + 1e-9).T + np.log(prior)
        new = np.exp(log - log.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        done, post = np.abs(new - post).max() < 1e-6, new
        if done:
            break
        confusion = post.T @ held + strength * start
        confusion /= confusion.sum(axis=1, keepdims=True)
        prior = (post.sum(axis=0) + 1) / (len(post) + n)
    return np.where(post.max(axis=1) >= sure, post.argmax(axis=1), -1)


def train(texts: list[str], labels: np.ndarray, idf: np.ndarray, clusters: int, draws: np.ndarray | None = None, rates: np.ndarray | None = None, seeds: int = 48, leaves: int = 8, rounds: int = 5, quantile: float = 0.002, slack: float = 0.6) -> Model:
    """Centroids per language from noisily labelled sentences; labels are language numbers.

    A text may stand there under several labels; `draws` says how often it was drawn under each, `rates`
    which share of the texts of each label was drawn.
    """
    dims, n = len(idf), len(LANGUAGES)
    anchor = _unit(_means(vectors([ANCHORS[k] for k in LANGUAGES], idf), np.arange(n), n, dims))
    if not texts:
        return Model(idf, anchor, np.arange(n), np.zeros(n))
    draws = np.ones(len(texts)) if draws is None else draws.astype(float)
    distinct, at = np.unique(np.array(texts, dtype=object), return_inverse=True)
    texts = distinct.tolist()
    by_label = np.zeros((len(texts), n))
    np.add.at(by_label, (at, labels), draws)
    sparse = vectors(texts, idf)
    # clusters of clusters, each named by the labels in it
    group, _ = _cluster(sparse, len(texts), dims, min(seeds, max(n, len(texts) // 4)), rounds)
    leaf = np.zeros(len(texts), np.int64)
    for g in range(int(group.max()) + 1):
        mine = np.flatnonzero(group == g)
        if len(mine):
            part, _ = _cluster(_rows(sparse, mine), len(mine), dims, max(1, min(leaves, len(mine) // 8)), rounds)
            leaf[mine] = part + int(leaf.max()) + 1
    held = np.zeros((int(leaf.max()) + 1, n))
    np.add.at(held, leaf, by_label)
    who = _named(held, np.ones(n) if rates is None else rates)[leaf]

    first = who

    def told(sims: np.ndarray, clear: float = 0.04, backed: float = 0.01) -> np.ndarray:
        """The nearest language of the texts that are told clearly, or less clearly but as their cluster or a label says.

        A text whose cluster is named otherwise is left out (-1) unless a label says so: an odd text that drifts
        to a wrong language would draw others after it.
        """
        best = sims.argmax(axis=1)
        two = np.sort(sims, axis=1)[:, -2:]
        lead = two[:, 1] - two[:, 0]
        agrees = by_label[np.arange(len(texts)), best] > 0
        return np.where((lead > backed) & (agrees | (best == first)) | (lead > clear) & (first < 0), best, -1)

    for _ in range(rounds):
        centre = _unit(_means(sparse, who, n, dims))
        lost = np.bincount(who[who >= 0], minlength=n) == 0
        centre[:, lost] = anchor[:, lost]
        now = told(similarities(sparse, len(texts), centre))
        if (now == who).all():
            break
        who = now
    columns, owner, reject = [], [], np.zeros(n)
    for k in range(n):
        mine = np.flatnonzero(who == k)
        if not len(mine):
            columns.append(anchor[:, [k]])
            owner.append(k)
            continue
        own = _rows(sparse, mine)

        def centroids(half: np.ndarray, own=own, size=len(mine)) -> np.ndarray:
            """The centroids of the sentences marked, and their mean."""
            part, count = _rows(own, np.flatnonzero(half)), int(half.sum())
            _, centre = _cluster(part, count, dims, min(clusters, count), rounds)
            return np.hstack([centre, _unit(_means(part, np.zeros(count, int), 1, dims))])

        centre = centroids(np.ones(len(mine), bool))
        columns.append(centre)
        owner += [k] * centre.shape[1]
        if len(mine) >= 2:
            # how near held-out sentences come: each half against the centroids of the other
            odd = np.arange(len(mine)) % 2 == 1
            near = np.where(odd, similarities(own, len(mine), centroids(~odd)).max(axis=1), similarities(own, len(mine), centroids(odd)).max(axis=1))
            reject[k] = slack * np.quantile(near, quantile)
    return Model(idf, np.hstack(columns), np.array(owner), reject)


def fit(documents: DataFrame, dims: int = 1 << 15, clusters: int = 3, sample: int = 800, per_document: int = 6) -> Model:
    """IDF over all documents; centroids from at most `per_document` sentences of each of about `sample` documents per labelled language."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter("text IS NOT NULL AND text <> ''")

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(dims, np.int64), 0
        for b in batches:
            for texts in _slices(b["text"].tolist()):
                total += np.bincount(features(texts, dims)[1], minlength=dims)
                n += len(texts)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"id": np.r_[-1, seen], "df": np.r_[n, total[seen]]})

    counted = docs.select("text").mapInPandas(frequencies, "id long, df long").groupBy("id").agg(F.sum("df").alias("df")).toPandas()
    df = np.zeros(dims)
    at = counted[counted["id"] >= 0]
    df[at["id"].to_numpy()] = at["df"].to_numpy()
    total = float(counted.loc[counted["id"] == -1, "df"].sum())
    idf = np.log((total + 1) / (df + 1)) + 0.1

    labelled = docs.withColumn("code", label_code(F.col("lang"))).filter("code IS NOT NULL AND doc_id IS NOT NULL")
    # one row per language
    share = {r["code"]: min(1.0, sample / r["count"]) for r in labelled.groupBy("code").count().collect()}
    if not share:
        return train([], np.empty(0, np.int64), idf, clusters)
    limit = F.try_element_at(F.create_map(*[F.lit(x) for pair in share.items() for x in pair]), F.col("code"))
    drawn = labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit("drawn")), F.lit(1 << 30)) < limit * (1 << 30)).select("doc_id", "code", "text")

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, code, text in zip(b["doc_id"], b["code"], b["text"], strict=True):
                s = sentences(text)
                s = [x for x, m in zip(s, letter_counts(s), strict=True) if m >= 20] if s else s
                if len(s) > per_document:
                    s = [s[i] for i in np.random.default_rng(doc & 0xFFFFFFFF).choice(len(s), per_document, replace=False)]
                out += [(LANGUAGES.index(code), x) for x in s]
            yield pd.DataFrame(out, columns=["k", "s"])

    rows = drawn.mapInPandas(pick, "k int, s string").groupBy("k", "s").agg(F.count("*").alias("n")).toPandas()
    rows = rows.sort_values(["k", "s"], kind="stable")
    return train(rows["s"].tolist(), rows["k"].to_numpy(np.int64), idf, clusters, rows["n"].to_numpy(np.int64), np.array([share.get(k, 1.0) for k in LANGUAGES]))


def _slices(texts: list[str], characters: int = 400_000) -> Iterator[list[str]]:
    """The texts in lists of about so many characters; a longer text is a list of its own."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= characters:
            yield part
            part, size = [], 0
    if part:
        yield part


# ---------------------------------------------------------------- documents and segments


def runs_of(kinds: list[int], sims: np.ndarray, margin: float) -> list[list[int]]:
    """The sentences of the longest runs in one language, in order."""
    groups: list[list[int]] = []
    for i, k in enumerate(kinds):
        if k < 0:
            continue
        if groups and kinds[groups[-1][-1]] == k:
            groups[-1].append(i)
        else:
            groups.append([i])
    # a lone sentence needs a clear lead over the language around it
    keep: list[list[int]] = []
    for g, members in enumerate(groups):
        near = [kinds[groups[j][0]] for j in (g - 1, g + 1) if 0 <= j < len(groups)]
        k = kinds[members[0]]
        if len(members) == 1 and near and max(sims[members[0]][k] - sims[members[0]][x] for x in near) < margin:
            continue
        if keep and kinds[keep[-1][0]] == k:
            keep[-1] += members
        else:
            keep.append(list(members))
    return keep or groups[:1]


def identify(documents: DataFrame, model: Model | None = None, margin: float = 0.05, batch_sentences: int = 20_000) -> DataFrame:
    """(doc_id, seg_no, lang, confidence, letters, label, mixed): seg_no 0 is the whole text, 1, 2, ... its runs."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model or fit(documents))

    def flush(held: list[tuple[int, str | None, list[str]]]) -> pd.DataFrame:
        m: Model = shared.value
        # a sentence that stands there more than once is scored once
        number: dict[str, int] = {}
        place = np.array([number.setdefault(s, len(number)) for _, _, ss in held for s in ss], np.int64)
        flat = list(number)
        kind, sims = m.classify(flat)
        size = letter_counts(flat)
        kind = np.where(size > 0, kind, -1)
        two = np.sort(sims, axis=1)[:, -2:]
        lead = two[:, 1] / np.maximum(two[:, 1] + np.maximum(two[:, 0], 0), 1e-12)
        kinds, sizes, leads = kind[place], size[place], lead[place]
        whole = (np.array([s.count(" ") for s in flat]) >= 2)[place] & (kinds >= 0)
        ends = np.cumsum([len(ss) for _, _, ss in held])
        out = []
        for (doc, label, _), begin, end in zip(held, np.r_[0, ends[:-1]], ends, strict=True):
            here = kinds[begin:end]
            if whole[begin:end].any():
                here = np.where(whole[begin:end], here, -1)
            told = here[here >= 0]
            if not len(told):
                continue
            if (told == told[0]).all():
                runs = [np.flatnonzero(here >= 0)]
            else:
                runs = runs_of(here.tolist(), sims[place[begin:end]], margin)
            rows = []
            total: dict[int, int] = {}
            for members in runs:
                at = begin + np.asarray(members)
                letters, k = int(sizes[at].sum()), int(here[members[0]])
                rows.append((k, letters, float((sizes[at] * leads[at]).sum() / max(letters, 1))))
                total[k] = total.get(k, 0) + letters
            most = max(total, key=lambda x: (total[x], -x))
            conf = sum(n * c for k, n, c in rows if k == most) / max(total[most], 1)
            mixed = len(total) > 1
            out.append((doc, 0, LANGUAGES[most], conf, sum(total.values()), label, mixed))
            out += [(doc, j, LANGUAGES[k], c, n, label, mixed) for j, (k, n, c) in enumerate(rows, 1)]
        return pd.DataFrame(out, columns=["doc_id", "seg_no", "lang", "confidence", "letters", "label", "mixed"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for b in batches:
            for doc, text, label in zip(b["doc_id"], b["text"], b["label"], strict=True):
                ss = sentences(text)
                if not ss:
                    continue
                held.append((doc, label, ss))
                n += len(ss)
                if n >= batch_sentences:
                    yield flush(held)
                    held, n = [], 0
        if held:
            yield flush(held)

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").alias("label")).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    return docs.mapInPandas(run, "doc_id long, seg_no int, lang string, confidence double, letters long, label string, mixed boolean")


def label_code(label: Column) -> Column:
    """language_of_label as an expression."""
    head = F.lower(F.regexp_extract(F.trim(label), r"^([^-_\s(.]*)", 1))
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in _CODE.items() for x in pair]), head)


def corrections(identified: DataFrame) -> DataFrame:
    """(doc_id, seg_no, lang): wrong or missing labels (0) and the runs of mixed documents (1, 2, ...)."""
    wrong = (F.col("seg_no") == 0) & (F.coalesce(label_code(F.col("label")), F.lit("")) != F.col("lang"))
    return identified.filter(wrong | ((F.col("seg_no") > 0) & F.col("mixed"))).select("doc_id", "seg_no", "lang")
