"""Metric stream: interval records and monitors with state per run.

A run's rows of one micro-batch meet in one task, sorted there, as rows inside a micro-batch have no
order. The size of the micro-batch (`maxFilesPerTrigger`) bounds them; the state is a few numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

INTERVAL_OUTPUT = (
    "run_id bigint, chunk_id bigint, global_step bigint, interval_steps bigint, "
    "train_loss double, grad_norm double, tokens bigint, samples bigint, "
    "tokens_seen bigint, samples_seen bigint"
)
INTERVAL_STATE = (
    "chunk_id bigint, interval bigint, step bigint, steps bigint, loss double, grad_norm double, "
    "tokens bigint, samples bigint, tokens_seen bigint, samples_seen bigint"
)


def interval_stream(steps: DataFrame, every: int) -> DataFrame:
    """Interval records as soon as they are due.

    `steps` needs (run_id, chunk_id, global_step, loss, grad_norm, tokens, samples, last_in_chunk).
    """

    def advance(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        parts = _interval_parts(list(frames), every)
        open_part = None
        seen = (0, 0)
        if state.exists:
            *values, tokens_seen, samples_seen = state.get
            seen = (tokens_seen, samples_seen)
            names = ("chunk_id", "interval", "step", "steps", "loss", "grad_norm", "tokens", "samples")
            open_part = dict(zip(names, values)) if values[3] > 0 else None
        out = []
        for part in parts:
            if open_part:
                if (open_part["chunk_id"], open_part["interval"]) == (part["chunk_id"], part["interval"]):
                    for name in ("steps", "loss", "grad_norm", "tokens", "samples"):
                        part[name] += open_part[name]
                else:
                    seen = _emit(out, key, open_part, seen)
            open_part = part
            if part.pop("due"):
                seen = _emit(out, key, open_part, seen)
                open_part = None
        kept = open_part or dict(
            chunk_id=0, interval=0, step=0, steps=0, loss=0.0, grad_norm=0.0, tokens=0, samples=0
        )
        state.update(
            (
                int(kept["chunk_id"]),
                int(kept["interval"]),
                int(kept["step"]),
                int(kept["steps"]),
                float(kept["loss"]),
                float(kept["grad_norm"]),
                int(kept["tokens"]),
                int(kept["samples"]),
                int(seen[0]),
                int(seen[1]),
            )
        )
        if out:
            yield pd.DataFrame(dict(zip((c.split()[0] for c in INTERVAL_OUTPUT.split(", ")), zip(*out))))

    found = steps.groupBy("run_id").applyInPandasWithState(
        advance, INTERVAL_OUTPUT, INTERVAL_STATE, "append", GroupStateTimeout.NoTimeout
    )
    return _nan_for_null(found, "train_loss", "grad_norm")


def _interval_parts(frames: list[pd.DataFrame], every: int) -> list[dict]:
    """What the rows of one run add to each (chunk, interval), in order of their steps.

    Plain arrays: a frame operation costs more than the rows of a short run. Rows without a chunk or
    a step are in no interval.
    """
    names = ("global_step", "chunk_id", "loss", "grad_norm", "tokens", "samples", "last_in_chunk")
    step, chunk, loss, norm, tokens, samples, last = (np.concatenate([f[name].to_numpy() for f in frames]) for name in names)
    order = np.argsort(step, kind="stable")
    known = ~(pd.isna(step) | pd.isna(chunk))
    if not known.all():
        order = order[known[order]]
    if not len(order):
        return []
    step, chunk = step[order], chunk[order]
    interval = -(-step // every)
    start = np.flatnonzero(np.append(True, (chunk[1:] != chunk[:-1]) | (interval[1:] != interval[:-1])))
    keys = list(zip(chunk[start].tolist(), interval[start].tolist()))
    numbers: dict[tuple, int] = {}
    place = np.array([numbers.setdefault(key, len(numbers)) for key in keys])
    if len(numbers) < len(keys):  # chunks alternate inside an interval: each is one part, from its first row on
        number = np.repeat(place, np.diff(np.append(start, len(order))))
        moved = np.argsort(number, kind="stable")
        order, step, keys = order[moved], step[moved], list(numbers)
        start = np.searchsorted(number[moved], np.arange(len(keys)))
    end = np.append(start[1:], len(order))
    due = np.logical_or.reduceat((step % every == 0) | (last[order] == True), start)  # noqa: E712 (a null is not due)
    sums = [np.add.reduceat(x[order], start).tolist() for x in (loss, norm)]
    sums += [np.add.reduceat(np.where(pd.isna(x), 0, x)[order], start).tolist() for x in (tokens, samples)]
    columns = (step[end - 1].tolist(), (end - start).tolist(), *sums, due.tolist())
    named = ("chunk_id", "interval", "step", "steps", "loss", "grad_norm", "tokens", "samples", "due")
    return [dict(zip(named, (*key, *values))) for key, values in zip(keys, zip(*columns))]


def _emit(out: list, key: tuple, part: dict, seen: tuple[int, int]) -> tuple[int, int]:
    seen = (seen[0] + part["tokens"], seen[1] + part["samples"])
    out.append(
        (
            key[0],
            part["chunk_id"],
            part["step"],
            part["steps"],
            part["loss"] / part["steps"],
            part["grad_norm"] / part["steps"],
            part["tokens"],
            part["samples"],
            *seen,
        )
    )
    return seen


MONITOR_OUTPUT = (
    "run_id bigint, record_seq bigint, global_step bigint, value double, smoothed double, "
    "is_best boolean, reaches_threshold boolean, stop_reason string"
)
MONITOR_STATE = (
    "recent array<double>, best double, has_best boolean, stop_best double, "
    "stop_best_step bigint, has_stop_best boolean, threshold_seen boolean"
)


def monitor_stream(
    records: DataFrame,
    window: int,
    mode: str = "min",
    min_delta: float = 0.0,
    threshold: float | None = None,
    once: bool = True,
    stop_threshold: float | None = None,
    patience: int = 0,
    warmup: int = 0,
) -> DataFrame:
    """Trailing mean and monitor events of one metric, record by record.

    `records` needs (run_id, record_seq, global_step, value), one row per record of the metric.
    `stop_reason` is what the metric rules say at that record, empty if nothing.
    """
    if mode not in ("min", "max"):
        raise ValueError("mode must be 'min' or 'max'")
    sign = 1.0 if mode == "min" else -1.0

    def reached(value: float, bound: float | None) -> bool:
        return bound is not None and sign * value <= sign * bound

    def advance(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values("record_seq", kind="stable")
        if state.exists:
            recent, best, has_best, stop_best, stop_step, has_stop, flagged = state.get
            recent = list(recent)
        else:
            recent, best, has_best, stop_best, stop_step, has_stop, flagged = (
                [], 0.0, False, 0.0, 0, False, False,
            )
        smoothed, is_best, hits, reasons = [], [], [], []
        for step, value in zip(rows["global_step"], rows["value"]):
            recent = [*recent[-(window - 1) :], value] if window > 1 else [value]
            mean = math.fsum(recent) / len(recent) if np.isfinite(recent).all() else sum(recent) / len(recent)
            better = not has_best or sign * mean < sign * best - min_delta
            if better:
                best, has_best = mean, True
            hit = reached(mean, threshold) and not (once and flagged)
            flagged = flagged or hit
            reason = ""
            if step >= warmup:
                if not has_stop or sign * mean < sign * stop_best - min_delta:
                    stop_best, stop_step, has_stop = mean, step, True
                if reached(mean, stop_threshold):
                    reason = "metric_threshold"
                elif patience > 0 and step - stop_step >= patience:
                    reason = "metric_patience"
            smoothed.append(mean)
            is_best.append(better)
            hits.append(hit)
            reasons.append(reason)
        state.update(
            (
                [float(x) for x in recent],
                float(best),
                bool(has_best),
                float(stop_best),
                int(stop_step),
                bool(has_stop),
                bool(flagged),
            )
        )
        yield pd.DataFrame(
            {
                "run_id": key[0],
                "record_seq": rows["record_seq"].to_numpy(),
                "global_step": rows["global_step"].to_numpy(),
                "value": rows["value"].to_numpy(),
                "smoothed": smoothed,
                "is_best": is_best,
                "reaches_threshold": hits,
                "stop_reason": reasons,
            }
        )

    found = records.groupBy("run_id").applyInPandasWithState(
        advance, MONITOR_OUTPUT, MONITOR_STATE, "append", GroupStateTimeout.NoTimeout
    )
    return _nan_for_null(found, "value", "smoothed")


def _nan_for_null(df: DataFrame, *columns: str) -> DataFrame:
    """Undo what pandas makes of NaN, in columns that are never null."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(float("nan"))) for c in columns})
