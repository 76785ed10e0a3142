"""One evolutionary step on a population matrix, shared by every search.

All randomness is hash-derived (md5 of ``seed:tag:generation:keys``), with the same keys as the DataFrame operators of
``evolve`` and the SQL oracles, so a step is a pure function of its arguments: it can be replayed after a lost driver and
is checked gene by gene.  A population is bounded by configuration; the pass over the data that scores it is in ``evolve``.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from ..functions.expr import HASH_SCALE
from .score import NetShape


#: Draws of at least so many keys are kept for the next search of a lock step, which asks for the same ones.
KEPT_DRAWS = 4096


def uniform(seed: int, tag: str, gen: int, *keys, end: str = "") -> np.ndarray:
    """Uniform draws in [0, 1), one for each combination of the key arrays (an outer product)."""
    lists = tuple(tuple(np.asarray(key).tolist()) for key in keys)
    size = math.prod(map(len, lists))
    draws = (_kept if size >= KEPT_DRAWS else _drawn)(f"{seed}:{tag}:{gen}", lists, end)
    return draws.reshape([len(key) for key in lists])


def _drawn(prefix: str, lists: tuple, end: str) -> np.ndarray:
    rows = [prefix]
    for key in lists:
        rows = [f"{r}:{k}" for r in rows for k in key]
    digests = b"".join([hashlib.md5((r + end).encode()).digest() for r in rows])
    words = np.frombuffer(digests, dtype=">u8")[::2] >> 16  # the first 48 bits of each
    return words.astype(np.float64) / HASH_SCALE


@lru_cache(maxsize=32)
def _kept(prefix: str, lists: tuple, end: str) -> np.ndarray:
    draws = _drawn(prefix, lists, end)
    draws.setflags(write=False)
    return draws


def normal(seed: int, tag: str, gen: int, *keys) -> np.ndarray:
    """Standard normal draws (Box-Muller over two uniforms)."""
    radius = np.sqrt(-2.0 * np.log(1.0 - uniform(seed, tag, gen, *keys, end=":a")))
    return radius * np.cos(2 * math.pi * uniform(seed, tag, gen, *keys, end=":b"))


def gene_scale(shape: NetShape, scale: float) -> np.ndarray:
    """Initial standard deviation of each gene."""
    sd = {"W1": scale * math.sqrt(2.0 / shape.d), "b1": 0.01, "W2": scale * math.sqrt(1.0 / shape.h), "b2": 0.05}
    return np.concatenate([np.full(count, sd[name]) for name, _, count in shape.segments()])


def first_population(shape: NetShape, individuals, seed: int, scale: float, gen: int = 0) -> np.ndarray:
    """One row for each individual number."""
    return normal(seed, "init", gen, individuals, np.arange(shape.n_params)) * gene_scale(shape, scale)


def by_fitness(fitness: np.ndarray) -> np.ndarray:
    """Individuals from best to worst, the lower number first on ties."""
    return np.lexsort((np.arange(len(fitness)), -fitness))


def rank_share(fitness: np.ndarray, s: float) -> np.ndarray:
    """Selection probability by rank, 0 the worst; ties rank by number."""
    n = len(fitness)
    rank = np.argsort(np.lexsort((np.arange(n), fitness)))
    return np.ones(1) if n == 1 else ((2.0 - s) + 2.0 * (s - 1.0) * rank / (n - 1)) / n


def roulette(share: np.ndarray, draws: int, seed: int, gen: int) -> np.ndarray:
    """E5: the individual whose cumulative interval holds the draw; past the last one, the last."""
    hits = np.searchsorted(np.cumsum(share), uniform(seed, "rank", gen, np.arange(draws)), side="right")
    return np.minimum(hits, len(share) - 1)


def tournament(better: np.ndarray, draws: int, k: int, seed: int, gen: int) -> np.ndarray:
    """Of k aspirants with replacement, the one that stands first in ``better`` (numbers from best to worst)."""
    place = np.argsort(better)
    aspirants = np.floor(uniform(seed, "tour", gen, np.arange(draws), np.arange(k)) * len(better)).astype(int)
    return better[place[aspirants].min(axis=1)]


def cross(mothers: np.ndarray, fathers: np.ndarray, kind: str, p: float, seed: int, gen: int) -> np.ndarray:
    """Two children a pair, interleaved; a pair whose draw is not below ``p`` is copied."""
    pairs, genes = mothers.shape
    number = np.arange(pairs)
    if kind == "uniform":
        own = uniform(seed, "ux", gen, number, np.arange(genes)) < 0.5
    elif kind == "one_point":
        cut = np.floor(uniform(seed, "cut", gen, number) * (genes - 1)).astype(int) + 1
        own = np.arange(genes) < cut[:, None]
    elif kind == "arithmetic":
        own = np.broadcast_to(uniform(seed, "alpha", gen, number)[:, None], mothers.shape)
    else:
        raise ValueError(f"unknown crossover: {kind}")
    if kind == "arithmetic":
        children = np.stack([own * mothers + (1 - own) * fathers, (1 - own) * mothers + own * fathers], axis=1)
    else:
        children = np.stack([np.where(own, mothers, fathers), np.where(own, fathers, mothers)], axis=1)
    crossed = uniform(seed, "px", gen, number) < p
    children = np.where(crossed[:, None, None], children, np.stack([mothers, fathers], axis=1))
    return children.reshape(2 * pairs, genes)


def perturb(pop: np.ndarray, first: int, p: float, sigma: float, seed: int, gen: int) -> np.ndarray:
    """Gaussian noise on the genes whose draw is below ``p``; ``first`` is the first row's individual number."""
    out = pop.copy()
    hit = uniform(seed, "mut", gen, first + np.arange(len(pop)), np.arange(pop.shape[1])) < p
    for i in np.flatnonzero(hit.any(axis=1)):
        at = np.flatnonzero(hit[i])
        out[i, at] += sigma * normal(seed, "mutn", gen, [first + i], at)[0]
    return out


def flip(masks: np.ndarray, first: int, p: float, seed: int, gen: int) -> np.ndarray:
    """Each bit changes if its draw is below ``p``."""
    return masks ^ (uniform(seed, "flip", gen, first + np.arange(len(masks)), np.arange(masks.shape[1])) < p)


@dataclass(frozen=True)
class StepConfig:
    """How parents are chosen and varied.  ``selection``: rank or tournament."""

    selection: str = "tournament"
    rank_s: float = 1.5
    tournament_k: int = 3
    crossover: str = "uniform"
    p_crossover: float = 0.9
    p_mutation: float = 0.05
    elitism: int = 2


def offspring(pop: np.ndarray, better: np.ndarray, share: np.ndarray | None, n: int, cfg: StepConfig, seed: int, gen: int) -> np.ndarray:
    """``n`` children of parents drawn by tournament over ``better`` or, given shares, by roulette; no mutation yet."""
    draws = n + n % 2
    chosen = roulette(share, draws, seed, gen) if share is not None else tournament(better, draws, cfg.tournament_k, seed, gen)
    return cross(pop[chosen[0::2]], pop[chosen[1::2]], cfg.crossover, cfg.p_crossover, seed, gen)[:n]


def next_generation(pop: np.ndarray, fitness: np.ndarray, cfg: StepConfig, sigma: float, seed: int, gen: int) -> np.ndarray:
    """Elites first, then mutated children."""
    better = by_fitness(fitness)
    share = rank_share(fitness, cfg.rank_s) if cfg.selection == "rank" else None
    children = offspring(pop, better, share, len(pop) - cfg.elitism, cfg, seed, gen)
    return np.concatenate([pop[better[: cfg.elitism]], perturb(children, cfg.elitism, cfg.p_mutation, sigma, seed, gen)])


def with_immigrants(pop: np.ndarray, n: int, shape: NetShape, scale: float, seed: int, gen: int) -> np.ndarray:
    """The last ``n`` places go to fresh individuals."""
    places = np.arange(len(pop) - n, len(pop))
    return np.concatenate([pop[:len(pop) - n], first_population(shape, places, seed, scale, gen)])


def next_masks(masks: np.ndarray, fitness: np.ndarray, cfg: StepConfig, seed: int, gen: int) -> np.ndarray:
    """The same with bit flips for Boolean genes."""
    better = by_fitness(fitness)
    children = offspring(masks, better, None, len(masks) - cfg.elitism, cfg, seed, gen)
    return np.concatenate([masks[better[: cfg.elitism]], flip(children, cfg.elitism, cfg.p_mutation, seed, gen)])


# ---------------------------------------------------------------------------
# Two objectives
# ---------------------------------------------------------------------------
def layers(objectives: np.ndarray) -> np.ndarray:
    """Front of each row of (n, 2) maximised objectives.

    Rows are visited by the first objective downwards, equal ones by the second downwards, so a row's dominators come
    before it.  ``tops[k]`` holds the best second objective of front k among larger first objectives; inside a run of equal
    first objectives only a strictly larger second one dominates.
    """
    front = np.zeros(len(objectives), int)
    tops: list[float] = []
    run: dict[int, float] = {}
    seen = None
    for i in np.lexsort((-objectives[:, 1], -objectives[:, 0])):
        x, y = objectives[i]
        if x != seen:
            for k, top in sorted(run.items()):
                tops[k:k + 1] = [max([top, *tops[k:k + 1]])]
            run, seen = {}, x
        k = 0
        while (k < len(tops) and tops[k] >= y) or run.get(k, -math.inf) > y:
            k += 1
        front[i] = k
        run[k] = max(y, run.get(k, -math.inf))
    return front


def spacing(objectives: np.ndarray, front: np.ndarray) -> np.ndarray:
    """Crowding of each row in its front: normalised gaps between its neighbours on every objective, ends infinite."""
    total = np.zeros(len(objectives))
    for column in objectives.T:
        order = np.lexsort((np.arange(len(front)), column, front))
        f, v = front[order], column[order]
        starts = np.flatnonzero(np.r_[True, f[1:] != f[:-1]])
        ends = np.r_[starts[1:], len(f)] - 1
        size = ends - starts + 1
        span = np.repeat(v[ends] - v[starts], size)
        gap = np.zeros(len(v))
        gap[1:-1] = v[2:] - v[:-2]
        part = np.divide(gap, span, out=np.zeros(len(v)), where=span > 0)
        part[starts] = part[ends] = math.inf
        total[order] += part
    return total


def by_front(objectives: np.ndarray) -> np.ndarray:
    """Rows by front, then the wider spacing, then the lower number."""
    front = layers(objectives)
    return np.lexsort((np.arange(len(front)), -spacing(objectives, front), front))


def next_front_children(pop: np.ndarray, objectives: np.ndarray, cfg: StepConfig, sigma: float, seed: int, gen: int) -> np.ndarray:
    """Mutated children of parents drawn by tournament on (front, spacing)."""
    children = offspring(pop, by_front(objectives), None, len(pop), cfg, seed, gen)
    return perturb(children, 0, cfg.p_mutation, sigma, seed, gen)
