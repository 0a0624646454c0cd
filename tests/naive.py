"""Plain definitions, row by row, of what the operators must give."""

import math


def chunks(texts, size, cap=None):
    """[(documents, source rows)] of a pull loop that stops at `cap` documents."""
    out, position, taken = [], 0, 0
    while cap is None or taken < cap:
        room = size if cap is None else min(size, cap - taken)
        docs = rows = 0
        while docs < room and position < len(texts):
            text = texts[position]
            position += 1
            rows += 1
            docs += bool(text is not None and text.strip())
        if docs == 0:
            break
        taken += docs
        out.append((docs, rows))
    return out


def windows(token_lists, length):
    """[(inputs, labels)] of one chunk's token stream."""
    stream = [token for tokens in token_lists for token in tokens]
    count = math.ceil((len(stream) - 1) / length)
    cut = [stream[s * length : s * length + length + 1] for s in range(count)]
    return [(w[:-1], w[1:]) for w in cut]


def improves(value, best, mode, delta):
    if best is None:
        return True
    return value < best - delta if mode == "min" else value > best + delta


def best(rows, mode, delta):
    """Sequence numbers of improvements in [(seq, step, value)]."""
    found, current = [], None
    for seq, _, value in rows:
        if improves(value, current, mode, delta):
            current = value
            found.append(seq)
    return found


def early_stop(rows, mode, delta, warmup, threshold, patience):
    """(seq, reason) of the first metric stop, or None."""
    current, at = None, 0
    for seq, step, value in rows:
        if step < warmup:
            continue
        if improves(value, current, mode, delta):
            current, at = value, step
        if threshold is not None and (value <= threshold if mode == "min" else value >= threshold):
            return seq, "metric_threshold"
        if patience > 0 and step - at >= patience:
            return seq, "metric_patience"
    return None


def smoothed(values, window):
    return [
        sum(values[max(0, i - window + 1) : i + 1]) / len(values[max(0, i - window + 1) : i + 1])
        for i in range(len(values))
    ]


def thinned(points, most):
    """Down-sampled [(step, value)]."""
    if len(points) <= most:
        return points
    kept = points[:: max(1, len(points) // most)]
    last, mine = points[-1], kept[-1]
    if last is not mine and not (last[0] == mine[0] and last[1] == mine[1]):
        kept = [*kept, last]
    return kept


def records(losses, every, chunk_steps):
    """[(step, mean)] of a run whose chunks have `chunk_steps` steps."""
    out, gathered = [], []
    for step, loss in enumerate(losses, 1):
        gathered.append(loss)
        if step % every == 0 or step % chunk_steps == 0 or step == len(losses):
            out.append((step, sum(gathered) / len(gathered)))
            gathered = []
    return out
