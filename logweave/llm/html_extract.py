"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element and every stretch of text in it is a node that bears content or not. Unary
potentials come from the node (element, what its class, id and role say, length, links and
punctuation of a text, place on the page); a potential on each parent-child edge lets them
agree. Sum-product messages go up from the leaves and down from the root, which on a tree
gives exact marginals; texts whose marginal of being content is above one half are the
article. The potentials are trained by maximum likelihood, with the same messages, on
labelled pages made by rule in many layouts (`training_pages` of them).

Pages are independent rows: no shuffle, and all pages of a slice exchange messages together.

Defined cases: NULL or empty html, or html without content, gives an empty text; a page is
read to its end however it is broken; references are decoded once; white space in a block,
no-break spaces included, becomes one space; rows are handled one by one, so repeated rows
get equal answers; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import html_samples, html_tree, tables
from logweave.llm.html_tree import NAMES, TAGS, Tree
from logweave.llm.tables import free, others

TRAINING_PAGES = 500
STEPS = 150
#: Kinds of edges by the child: element that says nothing by its names, element that does, text.
EDGES = 3
_SIZES = (len(TAGS) + 1, 6, 5, 2, 2, 4, len(TAGS), 2)  # element, words, links, sentence, sign, place, element of a text, edge of tree
_BASE = np.concatenate([[0], np.cumsum(_SIZES)])
WIDTH = int(_BASE[-1]) + len(NAMES)
#: Characters of html whose pages exchange messages together.
_SLICE = 1 << 20


class Forest(NamedTuple):
    """Nodes of several pages; nodes of one depth stand in `levels` together, roots first."""

    parent: np.ndarray
    kind: np.ndarray
    rows: np.ndarray  # (nodes, features) of weights
    names: np.ndarray  # (nodes, kinds of names) 0 or 1
    levels: list[np.ndarray]


class Model(NamedTuple):
    weights: np.ndarray  # of being content
    edges: np.ndarray  # (edge kinds, parent label, child label)


def forest(trees: Sequence[Tree]) -> Forest:
    sizes = np.array([len(t.parent) for t in trees], np.int64)
    shift = np.repeat(np.cumsum(sizes) - sizes, sizes)
    parent = np.array([p for t in trees for p in t.parent], np.int64)
    parent = np.where(parent < 0, -1, parent + shift)
    tag = np.array([x for t in trees for x in t.tag], np.int64)
    bits = np.array([x for t in trees for x in t.names], np.int64)
    words = np.array([x.count(" ") + 1 if x else 0 for t in trees for x in t.text], np.int64)
    chars = np.array([len(x) for t in trees for x in t.text], np.int64)
    linked = np.array([x for t in trees for x in t.linked], np.int64)
    ends = np.array([x[-1:] in ".!?:;…\"”" if x else False for t in trees for x in t.text])
    signs = np.array(["©" in x for t in trees for x in t.text])
    leaf = tag < 0
    names = (bits[:, None] >> np.arange(len(NAMES))) & 1
    place = (np.arange(len(parent)) - shift) / np.repeat(np.maximum(sizes, 1), sizes)
    columns = (
        np.where(leaf, len(TAGS), tag), np.where(leaf, 1 + np.searchsorted((4, 10, 25, 60), words, "right"), 0),
        np.where(leaf, 1 + np.searchsorted((0.01, 0.3, 0.8), linked / np.maximum(chars, 1), "right"), 0),
        ends & leaf, signs & leaf, np.searchsorted((0.1, 0.5, 0.9), place, "right"), np.where(leaf, tag[np.maximum(parent, 0)], 0), parent < 0)
    rows = np.stack([c.astype(np.int64) + b for c, b in zip(columns, _BASE, strict=False)], 1)
    kind = np.where(leaf, 2, (bits > 0) | np.isin(tag, _TELLING))
    depth = np.zeros(len(parent), np.int64)
    own = np.arange(len(parent))
    up = parent.copy()
    while (live := up >= 0).any():
        depth[live] += 1
        up[live] = parent[up[live]]
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(1, depth.max(initial=0) + 1))
    return Forest(parent, kind.astype(np.int64), rows, names, [own[x] for x in np.split(order, cuts)])


_TELLING = [TAGS[x] for x in "article main nav header footer aside form dialog search menu address".split()]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def sum_product(f: Forest, unary: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log of: node marginals, and for each edge (child) the joint of parent and child label; last, the log partition of all."""
    inside = unary.copy()
    up = np.zeros_like(unary)
    for level in reversed(f.levels[1:]):
        up[level] = _logsum(edges[f.kind[level]] + inside[level][:, None, :], 2)
        np.add.at(inside, f.parent[level], up[level])
    whole = inside.copy()
    joint = np.zeros((len(unary), 2, 2))
    for level in f.levels[1:]:
        cavity = whole[f.parent[level]] - up[level]
        pair = edges[f.kind[level]] + cavity[:, :, None] + inside[level][:, None, :]
        joint[level] = pair - _logsum(pair.reshape(len(level), 4), 1)[:, None, None]
        whole[level] = inside[level] + _logsum(edges[f.kind[level]] + cavity[:, :, None], 1)
    roots = f.levels[0]
    return whole - _logsum(whole, 1)[:, None], joint, _logsum(inside[roots], 1)


def unary_of(f: Forest, weights: np.ndarray) -> np.ndarray:
    out = np.zeros((len(f.parent), 2))
    out[:, 1] = weights[f.rows].sum(1) + f.names @ weights[_BASE[-1] :]
    return out


def fit(trees: Sequence[Tree], labels: np.ndarray, steps: int = STEPS, decay: float = 1e-4) -> Model:
    """Maximum likelihood with Adam."""
    f = forest(trees)
    child = np.flatnonzero(f.parent >= 0)
    gold_pair = np.zeros((EDGES, 2, 2))
    np.add.at(gold_pair, (f.kind[child], labels[f.parent[child]], labels[child]), 1)
    theta = np.zeros(WIDTH + EDGES * 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        weights, edges = theta[:WIDTH], theta[WIDTH:].reshape(EDGES, 2, 2)
        single, joint, _ = sum_product(f, unary_of(f, weights), edges)
        rest = labels - np.exp(single[:, 1])
        grad = np.zeros_like(theta)
        grad[: _BASE[-1]] = np.bincount(f.rows.ravel(), weights=np.repeat(rest, f.rows.shape[1]), minlength=_BASE[-1])
        grad[_BASE[-1] : WIDTH] = f.names.T @ rest
        expected = np.zeros((EDGES, 2, 2))
        np.add.at(expected, f.kind[child], np.exp(joint[child]))
        grad[WIDTH:] = (gold_pair - expected).ravel()
        grad = grad / max(len(trees), 1) - decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(theta[:WIDTH], theta[WIDTH:].reshape(EDGES, 2, 2))


def labelled(page: str) -> tuple[Tree, np.ndarray]:
    """Tree and labels of a made page: a text is content if marked, an element if it holds content."""
    tree = html_tree.read(page)
    labels = np.array([html_samples.MARK in x for x in tree.text], np.int64)
    for i in range(len(labels) - 1, 0, -1):
        labels[tree.parent[i]] |= labels[i]
    return tree._replace(text=[x.replace(html_samples.MARK, "") for x in tree.text]), labels


@cache
def trained(training_pages: int = TRAINING_PAGES) -> Model:
    pages = [labelled(x) for x in html_samples.pages(training_pages)]
    return fit([t for t, _ in pages], np.concatenate([y for _, y in pages]))


def main_texts(pages: Sequence[str], model: Model) -> list[str]:
    trees = [html_tree.read(x) for x in pages]
    if not trees:
        return []
    f = forest(trees)
    content = sum_product(f, unary_of(f, model.weights), model.edges)[0][:, 1] > np.log(0.5)
    out, at = [], 0
    for tree in trees:
        own = content[at : at + len(tree.text)].tolist()
        out.append("\n\n".join([x for x, c in zip(tree.text, own, strict=True) if c and x]))
        at += len(tree.text)
    return out


def _extract(model: Model):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[str] = []
            held: list[str] = []
            size = 0
            for page in batch.columns[-1].to_pylist():
                held.append(page)
                size += len(page)
                if size > _SLICE:
                    out += main_texts(held, model)
                    held, size = [], 0
            out += main_texts(held, model)
            keep = dict(zip(batch.schema.names[:-1], batch.columns[:-1], strict=True))
            yield pa.RecordBatch.from_pydict(keep | {"text": pa.array([x.encode("utf-8", "replace").decode() for x in out], pa.string()), "n_chars": pa.array([len(x) for x in out], pa.int64())})

    return work


def extract(pages: DataFrame, *columns: str, model: Model | None = None) -> DataFrame:
    """`columns` of pages, text and n_chars of the main text of html."""
    kinds, keep = dict(pages.dtypes), others(columns, ["text", "n_chars"])
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["text string", "n_chars bigint"])
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).alias(free(keep, "body"))
    return pages.select(*[f"`{c}`" for c in keep], body).mapInArrow(_extract(model or trained()), schema)


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(tables.read(spark, sf_dir, "pages"), "page_id", "url")


QUERIES = {"op5_html_extract": op5_html_extract}
#: A trained model is no SQL; tests hold marginals against enumeration and texts against made pages.
ORACLES: dict[str, str] = {}
