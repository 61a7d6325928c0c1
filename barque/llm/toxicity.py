"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier (operator 8).

Voters say toxic, clean or nothing. Three speak for a lexicon of insults written by hand; the rest for words and beginnings of
words of a lexicon that is induced on the development part of the labelled sample, dealt into several voters by hash: words,
beginnings, and beginnings that come back in two or three words of a text, which tell a manner of speech where no single
word does. For each kind of entry one voter says clean where a text has none. The label model sees the votes on the whole
sample and no labels: it estimates, by expectation maximisation, how often each voter says what in either class, and which
voters agree beyond that. A linear classifier is trained on its posteriors. Labels come back at the end alone, to turn
margins into probabilities.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barque.llm.linear import Model, constant, dual_descent, fit_in_task, log_ratios, platt, scored
from barque.llm.rolling import Rolling
from barque.llm.words import LOWER

PREFIXES = (4, 5, 6, 7, 8)
FIT_ROWS = 16_000
ENTRIES, LEAST, SHARE, Z = 600, 3, 0.85, 1.64
SHARED_LEAST = 5  # toxic texts of an entry of shared beginnings
DEALT = 4  # voters of each kind of entry
TIMES = (2, 3)  # a beginning that so many words of a text share is an entry of its own
KINDS = 1 + len(PREFIXES) * (1 + len(TIMES))
#: Insults that the first voters look for.
LEXICON = (
    "idiot idiots moron morons stupid loser losers trash worthless pathetic disgusting scum clown clowns dumb fool fools imbecile jerk bastard filthy vermin",
    "dumm idiot depp trottel arschloch abschaum widerlich wertlos müll dreck versager idiote imbécile stupide ordure crétin connard dégoûtant",
    "estúpido estúpida imbécil basura asqueroso idiota tonto tonta payaso inútil patético",
)
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def lower(raw: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 letters of UTF-8 bytes in lower case."""
    low = LOWER[raw]
    latin = np.flatnonzero((low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)) + 1
    low[latin] += 0x20
    return low


def features(data: bytes) -> np.ndarray:
    """Indicators of words (runs of letters), of their beginnings, and of beginnings that two or three words share."""
    if not data:
        return np.empty(0, np.uint32)
    low = lower(np.frombuffer(data, np.uint8))
    inside = np.zeros(len(low) + 2, np.int8)
    inside[1:-1] = _LETTER[low]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    roll = Rolling(low)
    parts = [_named(roll.spans(starts, ends), 0)]
    for kind, n in enumerate(PREFIXES, 1):
        long = starts[ends - starts > n]
        found, count = np.unique(roll.spans(long, long + n), return_counts=True)
        parts.append(_named(found, kind))
        parts += [_named(found[count >= times], kind + len(PREFIXES) * i) for i, times in enumerate(TIMES, 1)]
    return np.concatenate(parts)


def _named(hashes: np.ndarray, kind: int) -> np.ndarray:
    """32 bits of a hash, the last four of them for the kind of entry."""
    return (hashes >> np.uint64(32)).astype(np.uint32) & np.uint32(0xFFFFFFF0) | np.uint32(kind)


def numbered(rows: list[np.ndarray], least: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The hashes that at least `least` texts have, sorted, and each text's distinct features as places among them."""
    rows = [np.unique(x) for x in rows]
    keys, n = np.unique(np.concatenate(rows), return_counts=True)
    keys = keys[n >= least]
    out = []
    for x in rows:
        at = np.searchsorted(keys, x)
        at[at == len(keys)] = 0
        out.append(at[keys[at] == x] if len(keys) else at[:0])
    return keys, out


def shares(rows: list[np.ndarray], dim: int, rare: int = 200, bands: int = 6, width: int = 3) -> np.ndarray:
    """One over the number of texts that are near copies of a text, by MinHash bands over its rarer features; so that a
    text that was copied often counts once, and its chance words don't look like evidence."""
    df = np.zeros(dim, np.int64)
    for ids in rows:
        df[ids] += 1
    odd = np.random.default_rng(11).integers(1, 1 << 32, bands * width, dtype=np.uint64) | np.uint64(1)
    parent = np.arange(len(rows))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    seen: dict = {}
    for i, ids in enumerate(rows):
        own = ids[df[ids] <= rare].astype(np.uint64)
        if not len(own):
            continue
        low = ((own[:, None] * odd[None, :]) & np.uint64(0xFFFFFFFF)).min(axis=0)
        for b in range(bands):
            j = seen.setdefault((b, *low[b * width : (b + 1) * width].tolist()), i)
            parent[top(i)] = top(j)
    group = np.array([top(i) for i in range(len(rows))], np.int64)
    return 1 / np.bincount(group, minlength=len(rows))[group] if len(rows) else np.empty(0)


def telling(rows: list[np.ndarray], y: np.ndarray, share_of: np.ndarray, keys: np.ndarray, most: int = ENTRIES) -> np.ndarray:
    """Features whose texts are toxic in a share of SHARE, and surely of one half by the lower Wilson bound; at most
    `most`, those that speak most often first. Beginnings that words share need more toxic texts than the other kinds,
    as there are more of them to look right by chance."""
    dim = len(keys)
    counts = np.zeros((2, dim))
    for ids, label, part in zip(rows, y, share_of, strict=True):
        counts[int(label > 0)][ids] += part
    n = np.maximum(counts.sum(axis=0), 1)
    share, z2 = counts[1] / n, Z * Z
    low = (share + z2 / (2 * n) - Z * np.sqrt(share * (1 - share) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    least = LEAST if share_of[y > 0].sum() < 40 * LEAST else LEAST + 2
    least = np.where((keys & 15) > len(PREFIXES), max(least, SHARED_LEAST), least)
    worth = np.where((low > 0.5) & (share >= SHARE) & (counts[1] >= least), counts[1] * low, 0)
    return np.argsort(-worth, kind="stable")[: min(most, int((worth > 0).sum()))]


def votes_of(rows: list[np.ndarray], keys: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Votes (1 toxic, -1 clean, 0 nothing), rows x voters: the hand-written lexicons, the induced entries of each kind in
    DEALT voters, and for each kind one voter that says clean without an entry of it."""
    written = [np.unique(np.concatenate([features(w.encode())[:1] for w in words.split()])) for words in LEXICON]
    kind, part = keys[entries] & 15, (keys[entries] >> np.uint32(4)) * np.uint32(0x9E3779B1) >> np.uint32(30)
    voter = np.full(len(keys), -1)
    voter[entries] = kind * DEALT + part % DEALT
    by_hand = np.full(len(keys), -1)
    for j, words in enumerate(written):
        by_hand[np.isin(keys, words)] = j
    n, first = len(written), len(written) + KINDS * DEALT
    votes = np.zeros((len(rows), first + KINDS + 1), np.int8)
    for i, ids in enumerate(rows):
        votes[i, by_hand[ids][by_hand[ids] >= 0]] = 1
        votes[i, n + voter[ids][voter[ids] >= 0]] = 1
        votes[i, first:] = -1
    for k in range(KINDS):
        votes[votes[:, n + k * DEALT : n + (k + 1) * DEALT].any(axis=1), first + k] = 0
    votes[votes[:, :n].any(axis=1), first + KINDS] = 0
    return votes[:, np.abs(votes).any(axis=0)]


def label_model(votes: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Posterior that each row is toxic, from votes alone.

    Each voter has a rate of saying toxic, clean and nothing in either class; expectation maximisation starts from the
    sums of votes. Correlations: what two voters share beyond the classes, by their residuals; a voter counts by the
    inverse of the sum of its squared correlations, so that voters that say the same count once together.
    """
    said = np.stack([votes == 1, votes == -1, votes == 0]).astype(np.float64)  # 3, rows, voters
    speaks = np.where(votes > 0, 1.0, np.where(votes < 0, -0.5, 0.0)).sum(axis=1)
    post = np.clip(1 / (1 + np.exp(-speaks)), 0.02, 0.98)
    weight = np.ones(votes.shape[1])
    for i in range(rounds):
        prior = np.clip(post.mean(), 0.005, 0.995)
        toxic = (np.einsum("r,srv->sv", post, said) + 0.1) / (post.sum() + 0.3)
        clean = (np.einsum("r,srv->sv", 1 - post, said) + 0.1) / ((1 - post).sum() + 0.3)
        if i % 5 == 0:
            rest = votes - np.outer(post, toxic[0] - toxic[1]) - np.outer(1 - post, clean[0] - clean[1])
            size = np.sqrt((rest**2).sum(axis=0)) + 1e-9
            weight = 1 / ((rest.T @ rest / np.outer(size, size)) ** 2).sum(axis=1)
        logit = np.log(prior / (1 - prior)) + np.einsum("srv,sv->r", said, np.log(toxic / clean) * weight)
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        moved, post = np.abs(new - post).max(), new
        if moved < 1e-4 and i > 5:
            break
    return post


def fit(rows: list[np.ndarray], y: np.ndarray) -> Model:
    """Voters from the development part (four fifths), the label model on all, a linear model on its posteriors, and a
    probability curve on the last fifth, which no earlier step but the label model sees."""
    if len(set(y)) < 2 or min((y > 0).sum(), (y < 0).sum()) < 5:
        return constant(y, 0)
    fold = np.arange(len(rows)) % 10
    rest, development = fold >= 8, fold < 8
    if len(set(y[rest])) < 2 or len(rows) < 1000:
        rest, development = np.ones(len(rows), bool), np.ones(len(rows), bool)
    keys, some = numbered(rows, LEAST)
    dim = len(keys)
    share_of = shares(some, dim)
    pick = lambda mask: [some[i] for i in np.flatnonzero(mask)]
    entries = telling(pick(development), y[development], share_of[development], keys)
    votes = votes_of(some, keys, entries)
    post = label_model(votes) if votes.shape[1] else np.zeros(len(rows))
    label = np.where(post > 0.5, 1, -1)
    if len(set(label)) < 2:
        return constant(y, 0)
    train = ~rest | rest.all()
    use = np.sort(telling(pick(train), label[train], share_of[train], keys, dim))  # a word speaks for toxicity, none against it
    if not len(use):
        return constant(y, 0)
    ratio = np.zeros(dim)
    ratio[use] = np.maximum(log_ratios(pick(train), label[train], dim, alpha=0.5), 0)[use]
    ratio /= ratio.max() or 1
    even = len(label) / (2 * np.where(label > 0, (label > 0).sum(), (label < 0).sum()))
    w, bias = dual_descent(pick(train), label[train], (even * np.abs(2 * post - 1) * 10)[train], ratio)
    model = Model((w * ratio)[use], bias, 1.0, 0.0, keys[use])
    margin = np.array([model.margin(rows[i]) for i in np.flatnonzero(rest)])
    return model._replace(**dict(zip(("slope", "shift"), platt(margin, y[rest]), strict=True)))


def toxicity_scores(docs: DataFrame, labels: DataFrame, max_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher is more toxic), predicted (1 from 0.7 on) of every whole text.

    Fitted on at most max_rows labelled rows (doc_id, toxic) outside the held-out third; inputs are the text alone. Null
    labels are no labels; without labels of both kinds every score is the smoothed share of toxic ones. A null or empty
    text has a score like any other; a null id stays null; an empty table gives no rows; other columns are ignored.
    """
    model = fit_in_task(docs, labels, "toxic", features, fit, max_rows, id_col, text_col, np.uint32)
    return scored(docs, model, features, id_col, text_col).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
