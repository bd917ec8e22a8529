"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks.

Blocks of a page, in order, are labelled main text or not. Features of a block are its ancestor tags,
words of their class, id and role, and properties of its text; neighbouring labels are tied. The model
is trained by gradient descent on labelled pages: skeletons of common layouts filled with text of a
bounded sample of the pages, and the sampled pages that name their main part by ``article`` or
``main``. Decoding is exact (Viterbi), one pass per page.

Defined cases: a null or blank page, or one without main text, gives an empty text; pages are handled one
by one, so repeated rows and null ids change nothing; unclosed tags and comments end with the page;
an empty table gives an empty result and trains on the skeletons alone; only ``page_id, url, html`` are read.
"""

from __future__ import annotations

import re
import sys
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from namekin.llm.html_blocks import Block, blocks
from namekin.llm.labelled_pages import SKELETONS
from namekin.llm.words import slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Largest sample of pages that is used for training, the smallest by a hash of the page.
TRAIN_PAGES = 200
#: Blocks of one training sequence; a longer page gives several, so that a step takes bounded time in a row.
STRETCH = 200
FEATURES = 1 << 14
STEPS = 150
PULL = 1e-3
_MAIN = frozenset(["tag:article", "tag:main"])
_ASIDE = re.compile(
    r"name:(ad|ads|advert|advertisement|comment|comments|sidebar|nav|menu|footer|header|promo|banner|cookie|notice|related|share)$"
)
_ASIDE_TAGS = frozenset(["tag:nav", "tag:footer", "tag:aside", "tag:form", "tag:header"])


def _feature(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


def block_features(block: Block) -> list[int]:
    """Hashed features of one block."""
    words = block.text.count(" ") + 1
    names = [*block.ancestors, f"at:{block.tag}", f"words:{min(words.bit_length(), 6)}", "any"]
    names.append(f"linked:{int(block.linked * 2)}")
    names.append(f"ends:{block.text[-1] in '.!?:;' + chr(34)}")
    if re.search(r"©|\b[Cc]opyright\b", block.text):
        names.append("copyright")
    for main in _MAIN & block.ancestors:
        names += [f"{main}+{a}" for a in block.ancestors if a in _ASIDE_TAGS or _ASIDE.match(a)]
    return [_feature(n) for n in names]


@dataclass
class Crf:
    """Weights of features for label 1 against 0, of label pairs, and of the first and last label."""

    weights: np.ndarray
    pairs: np.ndarray

    def scores(self, page: list[list[int]]) -> np.ndarray:
        return np.array([self.weights[f].sum() for f in page])

    def decode(self, page: list[list[int]]) -> list[int]:
        """Best label sequence."""
        if not page:
            return []
        scores = self.scores(page).tolist()
        t = self.pairs.tolist()
        best, back = [0.0, scores[0]], []
        for s in scores[1:]:
            from0 = 0 if best[0] + t[0][0] >= best[1] + t[1][0] else 1
            from1 = 0 if best[0] + t[0][1] >= best[1] + t[1][1] else 1
            back.append((from0, from1))
            best = [best[from0] + t[from0][0], best[from1] + t[from1][1] + s]
        label = int(best[1] > best[0])
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


class _Packed:
    """Rows of sequences (blocks of pages), position by position: all first ones, then all second ones, and
    so on, the longest sequence first, so that a position is one stretch and one step for all sequences."""

    def __init__(self, lengths: list[int]):
        self.order = np.argsort([-n for n in lengths], kind="stable")
        lengths = np.array(lengths, np.int64)[self.order]
        #: Sequences that have each position, and its first row.
        self.width = np.array([np.searchsorted(-lengths, -i, "left") for i in range(lengths[0])] if len(lengths) else [], np.int64)
        self.start = np.cumsum([0, *self.width])
        self.sequence = np.concatenate([np.arange(n) for n in self.width]) if len(lengths) else np.zeros(0, np.int64)
        self.last = self.start[lengths - 1] + np.arange(len(lengths))
        self.later = np.arange(len(lengths), len(self.sequence))
        self.before = self.start[np.repeat(np.arange(len(self.width)), self.width)[self.later] - 1] + self.sequence[self.later]

    def rows(self, k: int) -> list[int]:
        """Row numbers of the sequence that was given as the ``k``-th in ``order``."""
        return (self.start[:-1][self.width > k] + k).tolist()

    def marginals(self, scores: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of label 1 per row, and expected label pairs, by forward and backward sums."""
        unary = np.stack([np.zeros(len(scores)), scores], axis=1)
        forward, backward = unary.copy(), np.zeros_like(unary)
        for i in range(1, len(self.width)):
            n, at, above = self.width[i], self.start[i], self.start[i - 1]
            x = forward[above : above + n, :, None] + pairs
            forward[at : at + n] += np.logaddexp(x[:, 0], x[:, 1])
        for i in range(len(self.width) - 1, 0, -1):
            n, at, above = self.width[i], self.start[i], self.start[i - 1]
            x = (unary[at : at + n] + backward[at : at + n])[:, None, :] + pairs
            backward[above : above + n] = np.logaddexp(x[:, :, 0], x[:, :, 1])
        total = np.logaddexp(*forward[self.last].T)[self.sequence][:, None]
        single = np.exp(forward + backward - total)[:, 1]
        double = forward[self.before][:, :, None] + pairs + (unary + backward - total)[self.later][:, None, :]
        return single, np.exp(double).sum(axis=0)


def train(labelled: list[tuple[list[list[int]], list[int]]], steps: int = STEPS) -> Crf:
    """Likelihood of the labelled pages, maximised by adaptive gradient steps."""
    crf = Crf(np.zeros(FEATURES), np.zeros((2, 2)))
    seen = np.full(FEATURES, 1e-8), np.full((2, 2), 1e-8)
    labelled = [(p, y) for p, y in labelled if p]
    if not labelled:
        return crf
    packed = _Packed([len(p) for p, _ in labelled])
    features, y = [[]] * len(packed.sequence), np.zeros(len(packed.sequence), np.int64)
    observed = np.zeros((2, 2))
    for k, which in enumerate(packed.order):
        page, labels = labelled[which]
        for row, f, label in zip(packed.rows(k), page, labels):
            features[row], y[row] = f, label
        np.add.at(observed, (labels[:-1], labels[1:]), 1.0)
    ids = np.concatenate([np.array(f, np.int64) for f in features])
    at = np.repeat(np.arange(len(features)), [len(f) for f in features])
    for _ in range(steps):
        scores = np.bincount(at, weights=crf.weights[ids], minlength=len(y))
        single, double = packed.marginals(scores, crf.pairs)
        g = np.bincount(ids, weights=(y - single)[at], minlength=FEATURES) / len(labelled) - PULL * crf.weights
        gp = (observed - double) / len(labelled) - PULL * crf.pairs
        for value, grad, s in ((crf.weights, g, seen[0]), (crf.pairs, gp, seen[1])):
            s += grad * grad
            value += 0.5 * grad / np.sqrt(s)
    return crf


def _named_labels(found: list[Block]) -> list[int] | None:
    """Labels of a page that names its main part, else None."""
    if not any(_MAIN & b.ancestors for b in found):
        return None
    return [
        int(bool(_MAIN & b.ancestors) and not (_ASIDE_TAGS & b.ancestors) and not any(map(_ASIDE.match, b.ancestors)))
        for b in found
    ]


def labelled_pages(sample: list[str]) -> list[tuple[list[list[int]], list[int]]]:
    """Features and labels of the filled skeletons and of all sampled pages that name their main part.

    A page of more than ``STRETCH`` blocks gives several sequences, which together hold all its blocks.
    """
    parsed = [blocks(p) for p in sample]
    texts = [b.text for page in parsed for b in page if b.text] or ["Lorem ipsum dolor sit amet."]
    long = sorted(t for t in texts if t.count(" ") >= 12) or texts
    short = sorted(t for t in texts if t.count(" ") < 12) or texts
    random = np.random.default_rng(5)

    def fill(skeleton):
        # A short phrase may stand where a paragraph does, and the other way round now and then.
        def one(m):
            pool = long if (m[1] == "p") != (random.random() < 0.15) else short
            return pool[random.integers(len(pool))].replace("&", "&amp;").replace("<", "&lt;")

        return re.sub(r"\{(p|s)\}", one, skeleton)

    out = []
    for skeleton in SKELETONS:
        for _ in range(6):
            found = blocks(fill(skeleton))
            out.append(([block_features(b) for b in found], [int(b.keep) for b in found]))
    for found in parsed:
        labels = _named_labels(found) or []
        for first in range(0, len(labels), STRETCH):
            part = slice(first, first + STRETCH)
            out.append(([block_features(b) for b in found[part]], labels[part]))
    return out


def fit(pages: DataFrame, rows: int = TRAIN_PAGES) -> Crf:
    """A model trained on the skeletons and at most ``rows`` pages."""
    hashed = pages.select("html", F.xxhash64("html").alias("h")).filter(F.length("html") > 0)
    least = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(rows).collect()]
    sample = hashed.filter(F.col("h") <= (least[-1] if least else 0)).select("html").distinct().orderBy("html")
    return train(labelled_pages([r["html"] for r in sample.collect()]))


def main_text(page: str | None, crf: Crf) -> str:
    found = blocks(page)
    labels = crf.decode([block_features(b) for b in found])
    return " ".join(b.text for b, y in zip(found, labels) if y)


def extract(pages: DataFrame, crf: Crf) -> DataFrame:
    """``(page_id, url, text, n_blocks, n_kept)``."""
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "html"):
                texts, n_blocks, n_kept = [], [], []
                for page in batch.column("html").to_pylist():
                    found = blocks(page)
                    labels = crf.decode([block_features(b) for b in found])
                    texts.append(" ".join(b.text for b, y in zip(found, labels) if y))
                    n_blocks.append(len(found))
                    n_kept.append(sum(labels))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                        pa.array(n_blocks, pa.int64()), pa.array(n_kept, pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_blocks", "n_kept"],
                )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_blocks long, n_kept long")
