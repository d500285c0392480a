"""A gated recurrent network over word numbers with a class-factored softmax, in numpy.

Gates and candidates use x / (1 + |x|), which numpy computes several times faster than the
logistic function and tanh. Results go into arrays that are used again: fresh ones of this size
cost more than what is computed into them.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache
from itertools import chain, islice
from pathlib import Path

import numpy as np

EMBEDDING = 16
HIDDEN = 16
#: About so many classes of words for the square root of the number of words.
CLASSES = 0.3
#: Tokens that gradients reach back through; the state goes on beyond them.
WINDOW = 32
#: A longer document is learned from in spans of so many tokens side by side, each after a run through
#: the window before it, which gives its state.
SPAN = 2048
#: Documents that learn side by side; one that ends makes room for the next.
LANES = 512
#: Step sizes at the beginning and the end of training, and steps of each replica until it is reached.
RATES = (0.03, 0.002)
WARM_UP = 8
CLIP = 5.0
#: Keeps parameters with hardly any gradient, as those of rare words, from moving like others.
DAMPING = 1e-5
#: A step on fewer tokens, as at the end of the last documents, is smaller in proportion.
FULL_STEP = 2048
#: Rows of the softmax that are computed together.
OUTPUT_ROWS = 2048
#: Rows of output that are computed together while scoring.
SCORED_ROWS = 16384


@cache
def one_blas_thread() -> None:
    """Lets numpy's matrix products run in one thread, once for a worker.

    They are small, so further threads only wait for each other, at the cost of other tasks.
    Where the library cannot be told, nothing changes but the time.
    """
    maps = Path("/proc/self/maps")
    loaded = {line.split()[-1] for line in maps.read_text().splitlines() if "openblas" in line} if maps.exists() else set()
    for path in loaded:
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)


class Documents:
    """Documents as lanes that run side by side, longest first; END begins and ends each."""

    def __init__(self, ids: list[np.ndarray], end: int = 0) -> None:
        self.lengths = np.array([len(x) for x in ids], np.int64)
        self.order = np.argsort(-self.lengths, kind="stable")
        self.sorted = self.lengths[self.order]
        self.flat = np.concatenate([*(ids[i] for i in self.order), np.zeros(1, np.int32)]).astype(np.int32)
        self.first = np.r_[0, np.cumsum(self.sorted)[:-1]] if len(ids) else np.empty(0, np.int64)
        self.end = end

    def active(self, at: int) -> int:
        """Lanes that have a token at this place."""
        return int(np.searchsorted(-self.sorted, -at, "left"))

    def window(self, at: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs (the token before), targets and which of them exist, as (size, lanes)."""
        lanes = self.active(at)
        place = at + np.arange(size)[:, None]
        there = place < self.sorted[:lanes]
        index = np.where(there, self.first[:lanes] + place, len(self.flat) - 1)
        before = self.flat[np.maximum(index - 1, 0)]
        if at == 0:
            before[0] = self.end
        return before, self.flat[index], there


def spans(docs: Iterator[np.ndarray], size: int, lead: int) -> Iterator[tuple[np.ndarray, int]]:
    """Documents in spans of `size` tokens, with how many tokens in front are only run through."""
    for ids in docs:
        for at in range(0, len(ids), size):
            before = min(at, lead)
            yield ids[at - before : at + size], before


def windows(docs: Iterator[tuple[np.ndarray, int]], lanes: int, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Windows of spans that run side by side; a lane whose span ends takes the next one.

    Each window has inputs (the token before; END before the first), targets, which of them are
    learned from and which begin a span, all as (size, lanes), and the lanes of the window before
    that go on.
    """
    running = [[*x, 0, 0] for x in islice(docs, lanes)]  # tokens, those not learned from, place, last token
    going = None
    while running:
        target = np.zeros((len(running), size), np.int32)
        there, fresh = np.zeros(target.shape, bool), np.zeros(target.shape, bool)
        before = np.zeros_like(target)
        for j, lane in enumerate(running):
            before[j, 0], at = lane[3], 0
            while at < size:
                if lane[2] == len(lane[0]):
                    found = next(docs, None)
                    if found is None:
                        break
                    lane[:3] = *found, 0
                ids, skip, start = lane[:3]
                take = min(size - at, len(ids) - start)
                fresh[j, at] = start == 0
                target[j, at : at + take] = ids[start : start + take]
                there[j, at + max(0, min(take, skip - start)) : at + take] = True
                lane[2], at = start + take, at + take
            lane[3] = target[j, at - 1]
        before[:, 1:] = target[:, :-1]
        before[fresh] = 0
        yield before.T, target.T, there.T, fresh.T, going
        # Lanes go on if something is left, or may still come.
        ready = next(docs, None)
        if ready is not None:
            docs = chain([ready], docs)
        going = np.array([j for j, lane in enumerate(running) if ready is not None or lane[2] < len(lane[0])], np.int64)
        running = [running[j] for j in going.tolist()]


def _order(numbers: np.ndarray, below: int) -> np.ndarray:
    """The stable order of numbers from 0 and `below` a bound; numpy sorts those of 16 bits several times faster."""
    return np.argsort(numbers.astype(np.uint16) if below <= 1 << 16 else numbers, kind="stable")


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where another number begins."""
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, np.int64)


def _by_gate(columns: np.ndarray) -> np.ndarray:
    """Columns of both gates as two arrays in a row; numpy is slow on parts of rows."""
    return np.ascontiguousarray(columns.reshape(-1, 2, HIDDEN).transpose(1, 0, 2))


class Network:
    """Parameters by name; word 0 is the end, 1 stands for all unknown ones, others are numbered by frequency.

    The end and the unknown words are classes of their own. The classes of other words hold words of
    like frequency and have about equal shares of the square roots of the counts, so that
    frequent words are in small classes.
    """

    def __init__(self, counts: np.ndarray, seed: int = 7) -> None:
        draw = np.random.default_rng(seed)
        n = len(counts)
        frequency = np.asarray(counts, np.float64) + 1.0
        parts = max(1, round(CLASSES * np.sqrt(n)))
        mass = np.cumsum(np.sqrt(frequency[2:]))
        cuts = np.searchsorted(mass, mass[-1] * np.arange(1, parts) / parts) + 3 if n > 2 else np.empty(0, np.int64)
        self.starts = np.unique(np.r_[np.arange(min(n, 2) + 1), cuts, n])
        self.words, self.classes = n, len(self.starts) - 1
        self.class_of = np.repeat(np.arange(self.classes, dtype=np.int32), np.diff(self.starts))
        near = lambda *shape: (draw.standard_normal(shape) * 0.1).astype(np.float32)
        by_class = np.add.reduceat(frequency, self.starts[:-1])
        self.p = {
            "embed": near(n, EMBEDDING),
            "w": near(EMBEDDING, 3 * HIDDEN),
            "u": near(HIDDEN, 3 * HIDDEN),
            "b": np.zeros(3 * HIDDEN, np.float32),
            "cw": near(HIDDEN, self.classes),
            # The start is about the frequency of each class, and of each word in its class.
            "cb": np.log(by_class / frequency.sum()).astype(np.float32),
            "ow": near(n, HIDDEN),
            "ob": np.log(frequency / by_class[self.class_of]).astype(np.float32),
        }
        self.p["cw"] *= np.float32(0.1)
        self.p["ow"] *= np.float32(0.1)
        #: Mean squares of the gradients, which go from round to round with the parameters.
        self.squares = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.settled = False
        self._spare: dict[str, np.ndarray] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_spare": {}}

    def state(self) -> np.ndarray:
        """Parameters and squares as one vector."""
        return np.concatenate([x[k].ravel() for x in (self.p, self.squares) for k in sorted(x)])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for x in (self.p, self.squares):
            for k in sorted(x):
                x[k] = flat[at : at + x[k].size].reshape(x[k].shape).astype(np.float32)
                at += x[k].size
        self.settled = True

    def _space(self, name: str, *shape: int) -> np.ndarray:
        """An array to write into; the next call with this name may give the same memory."""
        size = int(np.prod(shape))
        if name not in self._spare or self._spare[name].size < size:
            self._spare[name] = np.empty(size, np.float32)
        return self._spare[name][:size].reshape(shape)

    def _run(
        self, projected: np.ndarray, before: np.ndarray, h: np.ndarray, keep: list | None = None, fresh: np.ndarray | None = None
    ) -> np.ndarray:
        """The states after each input, in borrowed memory; `keep` gets what the way back needs.

        Where `fresh`, a document begins and the state with it.
        """
        n, (steps, lanes) = HIDDEN, before.shape
        kept = 1 if keep is None else steps
        out = self._space("states", steps, lanes, n)
        u_gates, u_new = _by_gate(self.p["u"][:, : 2 * n]), self.p["u"][:, 2 * n :].copy()
        p_gates, p_new = _by_gate(projected[:, : 2 * n]), projected[:, 2 * n :].copy()
        x, size, half = (self._space(k, 2, lanes, n) for k in ("x", "size", "half"))
        part, size_new = self._space("part", lanes, n), self._space("size_new", lanes, n)
        all_gates, all_y, all_new = self._space("gates", kept, 2, lanes, n), self._space("y", kept, lanes, n), self._space("new", kept, lanes, n)
        for t in range(steps):
            if fresh is not None and fresh[t].any():
                h = np.where(fresh[t][:, None], np.float32(0), h)
            at = min(t, kept - 1)
            gates, y, new = all_gates[at], all_y[at], all_new[at]
            p_gates.take(before[t], axis=1, out=x, mode="clip")
            np.matmul(h, u_gates, out=gates)
            gates += x
            np.abs(gates, out=size)
            size += 1.0
            gates /= size  # now within -1 and 1; half of that and a half is the gate
            np.multiply(gates, np.float32(0.5), out=half)
            half += 0.5
            z, r = half
            np.matmul(h, u_new, out=y)
            np.multiply(y, r, out=part)
            p_new.take(before[t], axis=0, out=new, mode="clip")
            new += part
            np.abs(new, out=size_new)
            size_new += 1.0
            new /= size_new
            if keep is not None:
                keep.append((h, gates, y, new))
            np.subtract(h, new, out=part)
            part *= z
            np.add(new, part, out=out[t])
            h = out[t]
        return out

    def _words_of(self, h: np.ndarray, target: np.ndarray, grads: dict | None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log-probability of each target after state h, and the gradient of minus its sum by h.

        The logits are small, as states lie within -1 and 1, so that they need no shift.
        """
        p, out = self.p, np.empty(len(target))
        order = _order(target, self.words)
        h, target = h.take(order, axis=0, out=self._space("by_target", *h.shape), mode="clip"), target[order]
        cls = self.class_of[target]
        back = None
        if grads is not None:
            back = self._space("back", *h.shape)
            for k in ("cw", "cb", "ow", "ob"):
                grads[k] = np.zeros_like(p[k])
        c_back = p["cw"].T.copy()
        every = np.arange(OUTPUT_ROWS)
        ones = np.ones(max(OUTPUT_ROWS, self.words), np.float32)  # products with it are faster than sums
        for a in range(0, len(h), OUTPUT_ROWS):
            b = min(a + OUTPUT_ROWS, len(h))
            hc, cc, rows = h[a:b], cls[a:b], every[: b - a]
            e = self._space("e", b - a, self.classes)
            np.matmul(hc, p["cw"], out=e)
            e += p["cb"]
            log = e[rows, cc]
            np.exp(e, out=e)
            e_sum = e @ ones[: self.classes]
            out[a:b] = log - np.log(e_sum)
            if grads is not None:
                e[rows, cc] -= e_sum  # the rows are divided by their sums where there are fewer columns
                share = 1 / e_sum
                grads["cw"] += (hc * share[:, None]).T @ e
                grads["cb"] += share @ e
                np.matmul(e, c_back, out=back[a:b])
                back[a:b] *= share[:, None]
        edges = _starts(cls)
        found = cls[edges]
        edges = [*edges.tolist(), len(h)]
        for i, c in enumerate(found.tolist()):
            span = slice(int(self.starts[c]), int(self.starts[c + 1]))
            width = span.stop - span.start
            if width == 1:  # its word is certain
                continue
            weights = p["ow"][span]
            o_weights = weights.T.copy()
            for a in range(edges[i], edges[i + 1], OUTPUT_ROWS):
                b = min(a + OUTPUT_ROWS, edges[i + 1])
                hc, at, rows = h[a:b], target[a:b] - span.start, every[: b - a]
                f = self._space("f", b - a, width)
                np.matmul(hc, o_weights, out=f)
                f += p["ob"][span]
                log = f[rows, at]
                np.exp(f, out=f)
                f_sum = f @ ones[:width]
                out[a:b] += log - np.log(f_sum)
                if grads is not None:
                    f[rows, at] -= f_sum
                    share = 1 / f_sum
                    grads["ow"][span] += f.T @ (hc * share[:, None])
                    grads["ob"][span] += share @ f
                    more = f @ weights
                    more *= share[:, None]
                    back[a:b] += more
        log = np.empty(len(out))
        log[order] = out
        if grads is not None:
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            back = back.take(place, axis=0)
        return log, back

    def score(self, docs: Documents) -> list[np.ndarray]:
        """The natural log-probability of each token of each document, the state carried to its end."""
        one_blas_thread()
        projected = self.p["embed"] @ self.p["w"] + self.p["b"]
        out = np.zeros(len(docs.flat))
        h, at, longest = np.zeros((len(docs.sorted), HIDDEN), np.float32), 0, int(docs.sorted[0]) if len(docs.sorted) else 0
        while at < longest:
            lanes = docs.active(at)
            size = min(longest - at, max(WINDOW, SCORED_ROWS // lanes))
            before, target, there = docs.window(at, size)
            states = self._run(projected, before, h[:lanes])
            # What is predicted at a place depends on the state after the token before it.
            log, _ = self._words_of(states[there], target[there], None)
            place = docs.first[:lanes] + at + np.arange(size)[:, None]
            out[place[there]] = log
            h, at = states[-1].copy(), at + size
        found = np.split(out[:-1], docs.first[1:]) if len(docs.sorted) else []
        back: list[np.ndarray] = [None] * len(found)  # type: ignore[list-item]
        for i, x in zip(docs.order.tolist(), found, strict=True):
            back[i] = x
        return back

    def train(self, docs: Iterator[np.ndarray], rate: float, lanes: int = LANES) -> int:
        """Learns from every window of each document, the state running through it. Returns the tokens."""
        one_blas_thread()
        h, learned, steps = np.zeros((0, HIDDEN), np.float32), 0, 0
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        for before, target, there, fresh, going in windows(spans(docs, SPAN, WINDOW), lanes, WINDOW):
            h = np.zeros((before.shape[1], HIDDEN), np.float32) if going is None else h[going]
            steps += 1
            h, grads = self._gradients(before, target, there, fresh, h)
            count = int(there.sum())
            self._step(grads, max(FULL_STEP, count), mean, steps, rate)
            learned += count
        if steps and not self.settled:  # the squares began at 0
            for v in self.squares.values():
                v /= np.float32(1 - 0.99**steps)
        return learned

    def _gradients(
        self, before: np.ndarray, target: np.ndarray, there: np.ndarray, fresh: np.ndarray, h: np.ndarray
    ) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """The state after a window and the gradients of minus the log-probability of its targets."""
        p, n, keep, grads = self.p, HIDDEN, [], {}
        # Only the window's words are projected.
        there_is = np.zeros(self.words, bool)
        there_is[before.ravel()] = True
        names = np.flatnonzero(there_is)
        local = (np.cumsum(there_is, dtype=np.int32) - 1)[before]
        projected = p["embed"][names] @ p["w"] + p["b"]
        states = self._run(projected, local, h, keep, fresh)
        whole = bool(there.all())
        _, back = self._words_of(states.reshape(-1, n) if whole else states[there], target.ravel() if whole else target[there], grads)
        if whole:
            outer = back.reshape(states.shape)
        else:
            outer = self._space("outer", *states.shape)
            outer[...] = 0
            outer[there] = back
        lanes = before.shape[1]
        dx, dy = self._space("dx", *before.shape, 3 * n), self._space("dy", *states.shape)
        dh, back_gates, back_new = np.zeros_like(states[0]), p["u"][:, : 2 * n].T.copy(), p["u"][:, 2 * n :].T.copy()
        half, slope = self._space("half", 2, lanes, n), self._space("slope", 2, lanes, n)
        bend, d_z, dn, dr = (self._space(k, lanes, n) for k in ("bend", "d_z", "dn", "dr"))
        one, share = np.float32(1), np.float32(0.5)
        for t in range(len(keep) - 1, -1, -1):
            prev, sign, yn, new = keep[t]
            np.multiply(sign, share, out=half)
            half += share
            z, r = half
            np.abs(sign, out=slope)
            np.subtract(one, slope, out=slope)
            slope *= slope
            slope *= share
            dh += outer[t]
            np.abs(new, out=bend)
            np.subtract(one, bend, out=bend)
            bend *= bend
            np.multiply(dh, z, out=d_z)
            np.subtract(dh, d_z, out=dn)
            dn *= bend
            np.subtract(prev, new, out=bend)
            bend *= dh
            bend *= slope[0]
            np.multiply(dn, yn, out=dr)
            dr *= slope[1]
            dx[t, :, :n], dx[t, :, n : 2 * n], dx[t, :, 2 * n :] = bend, dr, dn
            np.multiply(dn, r, out=dy[t])
            np.matmul(dx[t, :, : 2 * n], back_gates, out=dh)
            dh += d_z
            dh += dy[t] @ back_new
            if fresh[t].any():  # nothing goes back beyond a document's beginning
                dh[fresh[t]] = 0
        prevs = np.concatenate([x[0] for x in keep], out=self._space("prevs", before.size, n))
        flat, rows = local.ravel(), dx.reshape(-1, 3 * n)
        du = np.concatenate([prevs.T @ rows[:, : 2 * n], prevs.T @ dy.reshape(-1, n)], axis=1)
        order = _order(flat, len(names))
        ordered = rows.take(order, axis=0, out=self._space("ordered", *rows.shape), mode="clip")
        by_word = np.add.reduceat(ordered, _starts(flat[order]), axis=0)
        embed = np.zeros_like(p["embed"])
        embed[names] = by_word @ p["w"].T
        grads |= {"u": du, "w": p["embed"][names].T @ by_word, "b": by_word.sum(axis=0), "embed": embed}
        return states[-1].copy(), grads

    def _step(self, grads: dict[str, np.ndarray], count: int, mean: dict[str, np.ndarray], steps: int, rate: float) -> None:
        """Adam on the mean gradient, clipped in length; squares that came with the parameters need no correction."""
        length = np.sqrt(sum(float(np.vdot(g, g)) for g in grads.values())) / count
        factor = np.float32((1.0 if length <= CLIP else CLIP / length) / count)
        fast, slow = 1 - 0.9**steps, 1.0 if self.settled else 1 - 0.99**steps
        size = np.float32(rate * min(1.0, steps / WARM_UP) / fast)
        for k, g in grads.items():
            m, v = mean[k], self.squares[k]
            g *= factor
            m *= np.float32(0.9)
            m += np.float32(0.1) * g
            g *= g
            g -= v
            g *= np.float32(0.01)
            v += g
            np.divide(v, np.float32(slow), out=g)
            np.sqrt(g, out=g)
            g += np.float32(DAMPING)
            np.divide(m, g, out=g)
            g *= size
            self.p[k] -= g
