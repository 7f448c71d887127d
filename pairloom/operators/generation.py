"""Sequences written token by token: beam search, in batches of rows, over any next-token function."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.models import END_ID, MAX_LENGTH, residue_ids, structure_letters_of
from pairloom.operators.supervised import Guarded

#: (inputs, prefixes, parents) -> scores: for each hypothesis its row's token ids, what is written so far (all of one
#: length), and its parent's place in the call before (None in the first), so that a model can keep what it has computed.
Step = Callable[[list[list[int]], np.ndarray, np.ndarray | None], np.ndarray]

#: name -> factory of such a function; a worker calls the factory once.
GENERATORS: dict[str, Callable[[], Step]] = {}


def register_generator(name: str, factory: Callable[[], Step]) -> None:
    GENERATORS[name] = factory


@dataclass(frozen=True)
class Rules:
    """How a sequence is searched for. One beam takes the best token each time and ends with the end's token.

    `least` tokens come before the end may. The log probability of a token that the prefix has is multiplied by `penalty`.
    A hypothesis is worth its sum divided by its length (the end included) to the power `power`. With `early` the search
    ends when as many hypotheses as beams have ended, else when none can become better than the best. With a `seed` tokens
    are drawn (after `temperature`, of the `top_k` best, of the most likely that have `top_p` together), by a generator
    for each row, so that batches change nothing.
    """

    beams: int = 1
    end: int = END_ID
    least: int = 1
    penalty: float = 1.0
    power: float = 1.0
    early: bool = True
    seed: int | None = None
    temperature: float = 1.0
    top_k: int | None = None
    top_p: float = 1.0

    def __post_init__(self) -> None:
        if self.beams < 1 or self.penalty <= 0 or self.temperature <= 0 or self.power < 0 or not 0 < self.top_p <= 1:
            raise ValueError(f"no such search: {self}")


def narrowed(logp: np.ndarray, rules: Rules) -> np.ndarray:
    """Log probabilities of what may be drawn, -inf for the rest; of equal ones the smaller token is the better."""
    x = logp / rules.temperature
    order = np.argsort(-x, axis=-1, kind="stable")
    ranked = np.take_along_axis(x, order, -1)
    keep = np.arange(x.shape[-1]) < (rules.top_k or x.shape[-1])
    likely = np.where(keep, np.exp(ranked - ranked.max(axis=-1, keepdims=True)), 0.0)
    likely /= likely.sum(axis=-1, keepdims=True)
    keep = keep & (np.cumsum(likely, axis=-1) - likely < rules.top_p)  # the one that passes the bound is in
    out = np.full_like(x, -np.inf)
    np.put_along_axis(out, order, np.where(keep, ranked, -np.inf), -1)
    return out


def beam_search(step: Step, inputs: list[list[int]], most: list[int], rules: Rules, keys: list[str]) -> list[tuple[list[int], float]]:
    """(tokens without the end, value) of each row's best hypothesis of at most so many tokens; -inf if there is none."""
    beams, limit = rules.beams, np.array(most, int)
    longest = int(limit.max(initial=0))
    tokens = np.zeros((len(inputs), beams, longest), np.int32)
    sums = np.full((len(inputs), beams), -np.inf)
    sums[:, 0] = 0.0
    best, found, ended = np.full(len(inputs), -np.inf), [[] for _ in inputs], np.zeros(len(inputs), int)
    draws = None if rules.seed is None else [np.random.default_rng(int.from_bytes(hashlib.sha256(f"{rules.seed}:{k}".encode()).digest()[:8], "little")) for k in keys]
    live, parents = np.flatnonzero(limit > 0), None

    def settle(rows: np.ndarray, at: np.ndarray, value: np.ndarray, length: int) -> None:
        for r, b, v in zip(rows, at, value):
            if v > best[r]:
                best[r], found[r] = v, tokens[r, b, :length].tolist()

    for t in range(longest):
        if not len(live):
            break
        prefix = tokens[live, :, :t].reshape(len(live) * beams, t)
        logits = np.asarray(step([inputs[r] for r in live for _ in range(beams)], prefix, parents), float)
        top = logits.max(axis=1, keepdims=True)
        logp = logits - top - np.log(np.exp(logits - top).sum(axis=1, keepdims=True))
        if rules.penalty != 1.0 and t:
            seen = np.zeros(logp.shape, bool)
            seen[np.arange(len(logp))[:, None], prefix] = True
            logp = np.where(seen, logp * rules.penalty, logp)
        if t < rules.least:
            logp[:, rules.end] = -np.inf
        if draws is not None:
            logp = narrowed(logp, rules)
        size = logp.shape[1]
        total = (sums[live].reshape(-1, 1) + logp).reshape(len(live), beams * size)
        # Drawing without replacement in proportion to the probabilities is taking the largest of them with Gumbel noise.
        rank = total if draws is None else total + np.stack([draws[r].gumbel(size=beams * size) for r in live])
        k = 1 if beams == 1 else min(2 * beams, beams * size)
        order = rank.argmax(axis=1)[:, None] if k == 1 else np.argsort(-rank, axis=1, kind="stable")[:, :k]
        value, beam, token = np.take_along_axis(total, order, 1), order // size, order % size
        over = token == rules.end
        for j in range(min(beams, k)):
            hit = np.flatnonzero(over[:, j] & np.isfinite(value[:, j]))
            ended[live[hit]] += 1
            settle(live[hit], beam[hit, j], value[hit, j] / (t + 1) ** rules.power, t)
        going = np.argsort(over, axis=1, kind="stable")[:, :beams]  # the first that go on, in order
        value = np.where(np.take_along_axis(over, going, 1), -np.inf, np.take_along_axis(value, going, 1))
        beam, token = np.take_along_axis(beam, going, 1), np.take_along_axis(token, going, 1)
        if beams > 1:
            tokens[live, :, :t] = tokens[live[:, None], beam, :t]
        tokens[live, :, t], sums[live] = token, value
        last = limit[live] == t + 1
        full = live[last]
        top_beam = sums[full].argmax(axis=1)
        settle(full, top_beam, sums[full, top_beam] / (t + 1) ** rules.power, t + 1)
        reach = value.max(axis=1)
        # Sums only fall, so no hypothesis that goes on becomes worth more than its sum over the greatest length.
        stop = last | ~np.isfinite(reach) | ((ended[live] >= beams) if rules.early else reach / limit[live] ** rules.power <= best[live])
        parents = (np.arange(len(live))[:, None] * beams + beam)[~stop].reshape(-1)
        live = live[~stop]
    return list(zip(found, best.tolist()))


def generate(df: DataFrame, key: str, ids: str, most: Column, generator: str, rules: Rules = Rules(), batch: int = 8, done: DataFrame | None = None, seconds: float | None = None) -> DataFrame:
    """(key, most, tokens, value, error): what a registered generator writes for each row's token ids, `most` tokens at most.

    Rows without ids have no tokens and no error; a row that nothing can be written for has NULL for tokens. Batches are
    made of rows of like size of a partition, and change no result. Ids that `done` has are left out. Batches that fail
    are halved, and with `seconds` killed, as in embed(). Nothing is shuffled but for the sort within partitions.
    """
    factory = GENERATORS[generator]
    if done is not None:
        df = df.join(done.select(key).distinct(), key, "left_anti")

    def made() -> Callable[[list[tuple]], list]:
        step = factory()
        return lambda items: beam_search(step, [x for _, x, _ in items], [n for _, _, n in items], rules, [k for k, _, _ in items])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with Guarded(made, seconds) as model:
            for frame in frames:
                for at in range(0, len(frame), batch):
                    part = frame.iloc[at : at + batch]
                    items = [(str(k), [int(i) for i in x], int(n)) for k, x, n in zip(part[key], part["__ids"], part["__most"]) if x is not None]
                    told = iter(model(items) if items else [])
                    rows = [((None, None), None) if x is None else next(told) for x in part["__ids"]]
                    good = [v if v is not None and v[0] is not None and np.isfinite(v[1]) else (None, None) for v, _ in rows]
                    yield pd.DataFrame({key: part[key], "most": part["__most"], "tokens": [v for v, _ in good], "value": [v for _, v in good], "error": [e for _, e in rows]})

    kind = df.schema[key].dataType.simpleString()
    x = df.select(key, F.col(ids).alias("__ids"), F.coalesce(most, F.lit(0)).cast("int").alias("__most"))
    return x.sortWithinPartitions(F.size("__ids").desc()).mapInPandas(run, f"`{key}` {kind}, most int, tokens array<int>, value double, error string")


def structure_by_generation(df: DataFrame, key: str, sequence: str, generator: str, rules: Rules = Rules(), most: int = MAX_LENGTH, extra: int = 8, batch: int = 8, done: DataFrame | None = None, seconds: float | None = None) -> DataFrame:
    """(key, letters, error): structure letters of residues, one for each, by a model of both languages.

    Up to `extra` tokens more than residues may be written; what is beyond them is cut off, what lacks is filled up. A
    NULL sequence has NULL letters, an empty one an empty text.
    """
    x = df.select(key, residue_ids(F.col(sequence), most).alias("__in"))
    told = generate(x, key, "__in", F.size("__in") - 2 + extra, generator, rules, batch, done, seconds)
    return told.select(key, structure_letters_of(F.col("tokens"), F.col("most") - extra).alias("letters"), "error")
