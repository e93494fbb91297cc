"""A gated recurrent network over symbols in numpy: scoring, and training by truncated backpropagation.

The network reads a symbol per step; its output is factored into the class of the next symbol and
the symbol within the class. Many streams of documents run side by side. A stream's state is carried
from window to window and set back at the start of a document, so a document of any length is read
as a whole; gradients go back to the start of a window.
"""

import heapq

import numpy as np

#: Units of the state.
UNITS = 16
#: Steps of a window and streams side by side, in training and in scoring.
TRAIN_STEPS, TRAIN_STREAMS, SCORE_STEPS, SCORE_STREAMS = 16, 256, 32, 1024


def layout(symbols, classes, units=UNITS):
    """Name -> shape of the parameters."""
    return {
        "x": (symbols, 3 * units),
        "u": (units, 3 * units),
        "wc": (units, classes),
        "bc": (classes,),
        "wo": (symbols, units),
        "bo": (symbols,),
    }


def unpack(vector, shapes):
    """Views of one parameter vector."""
    out, at = {}, 0
    for name, shape in shapes.items():
        size = int(np.prod(shape))
        out[name] = vector[at : at + size].reshape(shape)
        at += size
    return out


def initial(counts, starts, units=UNITS):
    """Parameters that predict the smoothed frequencies of symbols and classes, whatever the state.

    Symbols are numbered so that those of class k are starts[k]:starts[k + 1].
    """
    shapes = layout(len(counts), len(starts) - 1, units)
    vector = np.zeros(sum(int(np.prod(shape)) for shape in shapes.values()), np.float32)
    p, draw = unpack(vector, shapes), np.random.default_rng(5)
    p["x"][:] = draw.normal(0, 0.1, p["x"].shape)
    p["u"][:] = draw.normal(0, 1 / np.sqrt(units), p["u"].shape)
    p["bo"][:] = np.log(counts / np.repeat(np.add.reduceat(counts, starts[:-1]), np.diff(starts)))
    p["bc"][:] = np.log(np.add.reduceat(counts, starts[:-1]) / counts.sum())
    return vector


def streams(documents, width):
    """Documents dealt out to `width` streams of nearly equal length, longest documents first.

    documents are symbol arrays. Returns the numbers of the documents of each stream, and the
    streams' lengths, the longest stream first.
    """
    order = sorted(range(len(documents)), key=lambda k: -len(documents[k]))
    width = max(1, min(width, len(documents)))
    lengths, members = [0] * width, [[] for _ in range(width)]
    heap = [(0, k) for k in range(width)]
    for k in order:
        held, stream = heap[0]
        heapq.heapreplace(heap, (held + len(documents[k]), stream))
        members[stream].append(k)
        lengths[stream] += len(documents[k])
    by_length = sorted(range(width), key=lambda s: -lengths[s])
    return [members[stream] for stream in by_length], np.array([lengths[stream] for stream in by_length])


def windows(documents, width, start_symbol, steps):
    """Windows (inputs, targets, starts, documents) of shape (steps, streams still running).

    Streams end at different steps; a window has only streams that run through it, and the last steps
    of a stream form shorter windows. Streams lie one after the other and a window is gathered when it
    is used, so memory goes with the symbols, not with the longest document times the streams.
    """
    members, lengths = streams(documents, width)
    parts = [k for members_of in members for k in members_of]
    sizes = np.array([len(documents[k]) for k in parts])
    symbols = np.concatenate([documents[k] for k in parts])
    number = np.repeat(np.array(parts, np.int32), sizes)
    first = np.zeros(len(symbols), bool)
    first[np.cumsum(sizes) - sizes] = True
    offsets = np.cumsum(lengths) - lengths
    at, size = 0, int(lengths[0])
    while at < size:
        running = int((lengths > at).sum())
        end = min(at + steps, int(lengths[running - 1]))
        cells = offsets[:running] + np.arange(at, end)[:, None]
        start = first[cells]
        # The symbol before the first one is not read: a document starts there.
        read = np.where(start, start_symbol, symbols[cells - 1].astype(np.int64))
        yield read, symbols[cells].astype(np.int64), start, number[cells]
        at = end


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def _forward(p, read, start, state, keep=None):
    """States after each step, shape (steps, streams, units); keep gets what backpropagation needs."""
    units = state.shape[1]
    steps, width = read.shape
    states = np.empty((steps, width, units), np.float32)
    x = p["x"][read]
    for t in range(steps):
        if start[t].any():
            state = np.where(start[t][:, None], np.float32(0), state)
        g = state @ p["u"]
        zr = _sigmoid(x[t, :, : 2 * units] + g[:, : 2 * units])
        z, r = zr[:, :units], zr[:, units:]
        n = np.tanh(x[t, :, 2 * units :] + r * g[:, 2 * units :])
        if keep is not None:
            keep.append((state, zr, n, g[:, 2 * units :]))
        state = n + z * (state - n)
        states[t] = state
    return states


#: Logits are kept within these bounds, where exponentials of single precision cannot overflow.
MOST = np.float32(60)
#: Sums by row are products with ones; there are fewer symbols than 16-bit numbers.
_ONES = np.ones(1 << 16, np.float32)


def _softmax(logits):
    """Exponentials of logits, and their sums by row."""
    np.minimum(logits, MOST, out=logits)
    np.maximum(logits, -MOST, out=logits)
    np.exp(logits, out=logits)
    return logits, logits @ _ONES[: logits.shape[1]]


def _outputs(p, states, target, starts, class_of, grad=None):
    """Natural log probabilities of targets; with grad also the gradient of their negative sum."""
    wanted = target.ravel()
    classes = class_of[wanted]
    # Rows of one class lie together. Numbers of 16 bits are sorted by radix.
    order = np.argsort(classes.astype(np.uint16), kind="stable")
    flat, wanted, classes = states.reshape(-1, states.shape[-1])[order], wanted[order], classes[order]
    edges = np.searchsorted(classes, np.arange(len(starts))).tolist()
    rows = np.arange(len(flat))
    prob, total = _softmax(flat @ p["wc"] + p["bc"])
    likely = prob[rows, classes] / total
    back = None
    if grad is not None:
        prob /= total[:, None]
        prob[rows, classes] -= 1
        grad["wc"] += flat.T @ prob
        grad["bc"] += prob.sum(axis=0)
        back = prob @ p["wc"].T
    for k in range(len(starts) - 1):
        lo, hi, a, b = starts[k], starts[k + 1], edges[k], edges[k + 1]
        if a == b or hi - lo == 1:
            continue
        held, own, inside = flat[a:b], wanted[a:b] - lo, rows[: b - a]
        prob, total = _softmax(held @ p["wo"][lo:hi].T + p["bo"][lo:hi])
        likely[a:b] *= prob[inside, own] / total
        if grad is not None:
            prob /= total[:, None]
            prob[inside, own] -= 1
            grad["wo"][lo:hi] += prob.T @ held
            grad["bo"][lo:hi] += prob.sum(axis=0)
            back[a:b] += prob @ p["wo"][lo:hi]
    logp = np.empty(len(flat))
    logp[order] = np.log(likely.astype(np.float64))
    if grad is not None:
        scattered = np.empty_like(back)
        scattered[order] = back
        back = scattered
    return logp, back


def _backward(p, grad, read, start, kept, back):
    """Add the gradient of a window, from that of its states."""
    units = p["u"].shape[0]
    d_state = np.zeros_like(back[0])
    d_x = np.empty((*read.shape, 3 * units), np.float32)
    for t in range(len(kept) - 1, -1, -1):
        state, zr, n, gn = kept[t]
        z, r = zr[:, :units], zr[:, units:]
        d = d_state + back[t]
        d_n = d * (1 - z) * (1 - n * n)
        d_zr = np.concatenate([d * (state - n), d_n * gn], axis=1) * zr * (1 - zr)
        d_x[t, :, : 2 * units], d_x[t, :, 2 * units :] = d_zr, d_n
        d_g = np.concatenate([d_zr, d_n * r], axis=1)
        grad["u"] += state.T @ d_g
        d_state = d * z + d_g @ p["u"].T
        if start[t].any():
            d_state[start[t]] = 0
    symbols, flat = read.ravel(), d_x.reshape(-1, 3 * units)
    order = np.argsort(symbols.astype(np.uint16), kind="stable")
    held = symbols[order]
    first = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
    grad["x"][held[first]] += np.add.reduceat(flat[order], first, axis=0)


class Adam:
    """Running means that scale the steps of a task's training."""

    def __init__(self, vector, rate):
        self.rate, self.steps = rate, 0
        self.mean, self.square = np.zeros_like(vector), np.zeros_like(vector)

    def step(self, vector, gradient, symbols):
        self.steps += 1
        self.mean += 0.1 * (gradient - self.mean)
        self.square += 0.01 * (gradient * gradient - self.square)
        size = self.rate * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        # Windows of few symbols have noisy gradients and take shorter steps.
        vector -= np.float32(size * min(1.0, symbols / 1024)) * self.mean / (np.sqrt(self.square) + np.float32(1e-6))


def train(vector, documents, starts, class_of, start_symbol, optimizer, units=UNITS):
    """Change the parameters by one pass over documents; returns the number of symbols."""
    symbols = len(class_of)
    shapes = layout(symbols, len(starts) - 1, units)
    p, gradient = unpack(vector, shapes), np.zeros_like(vector)
    grad = unpack(gradient, shapes)
    state, done = None, 0
    for read, target, start, _ in windows(documents, TRAIN_STREAMS, start_symbol, TRAIN_STEPS):
        gradient[:] = 0
        width = read.shape[1]
        state = np.zeros((width, units), np.float32) if state is None else state[:width]
        kept = []
        states = _forward(p, read, start, state, kept)
        _, back = _outputs(p, states, target, starts, class_of, grad)
        _backward(p, grad, read, start, kept, back.reshape(states.shape))
        state = states[-1]
        gradient /= target.size
        done += target.size
        optimizer.step(vector, gradient, target.size)
    return done


def score(vector, documents, starts, class_of, start_symbol, units=UNITS):
    """Natural log probability of each document."""
    p = unpack(vector, layout(len(class_of), len(starts) - 1, units))
    out, state = np.zeros(len(documents)), None
    for read, target, start, number in windows(documents, SCORE_STREAMS, start_symbol, SCORE_STEPS):
        width = read.shape[1]
        state = np.zeros((width, units), np.float32) if state is None else state[:width]
        states = _forward(p, read, start, state)
        logp, _ = _outputs(p, states, target, starts, class_of)
        out += np.bincount(number.ravel(), logp, len(documents))
        state = states[-1]
    return out
