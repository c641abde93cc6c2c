"""Language-model scores of whole documents from a gated recurrent network in numpy.

Counts come first: every token of every training document is counted (``token_counts``), and the
``HEAD`` most frequent tokens get a place of their own in the tasks. The network predicts a
class and then the word in it:

* the ``SOFT`` most frequent tokens, in classes of ``CLASS_WORDS``: the word's softmax in its
  class also reads the network's state;
* the rest of the head in ``BANDS`` frequency bands, and all other tokens in classes by how they
  look (length, ASCII or not, a letter at the end or not): inside these the word's share is
  its share of the class's count. A class of the second kind keeps a share for words never seen,
  the share of its words seen once (Good-Turing), as one word, as the base score does.

Weights are fitted by truncated backpropagation, the state being carried from window to window. A first
pass over ``START_TOKENS`` tokens at most on the driver only gives the tasks a common start. From it every task
trains on all its training documents, in blocks of ``TRAIN_BLOCK`` tokens, and the mean of
their weights by tokens is the model. So weights, like counts, classes and shares, are of all training documents.

Texts are taken apart twice, for the counts and then for ids of two bytes a token, which training and scoring read.
Scoring runs in tasks over whole documents: texts advance together, the state of each carried
across windows to its end. The counts of the ``MORE`` next tokens meet the texts with the ids. All other tokens go to one shuffle on the token, each once per
document, to meet their counts; no token there is frequent, so no key is hot.

Lanes and texts that advance together are columns of all arrays, so numpy works along them, and what a step
of a window needs is small enough for a core's cache.

Defined cases: a null or empty text has its end alone. A null id counts as the text ''. Repeated rows
are counted and scored as rows of their own. Without training documents all counts are 0 and every
token is unseen. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, fields
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.averaging import averaged_round
from marginalia.llm.common import bounded_sample, byte_tokens
from marginalia.session import batches_of, materialize

END = b""  # no token of a text is empty
HEAD = 32_768
MORE = 131_072  # tokens beyond the head whose counts go to the tasks
LOOKS_KEPT = 100_000
SOFT, CLASS_WORDS = 2_048, 64
BANDS = 8
LOOKS = 20
EMBED, HIDDEN = 16, 24
WINDOW = 16
START_TOKENS, START_DOCS, LANES = 400_000, 3_000, 64
TASK_LANES, TASK_RATE = 512, 0.01
TRAIN_BLOCK = 1_000_000  # tokens a task trains on at a time
BLOCK_TOKENS = 3_000_000
SCORED_TOKENS = 16_384  # states held at a time
PIECE = 512  # of which so many meet the classes at a time
EXP_RANGE = 80  # scores up to it need no shift before ``exp``
SCORED_LANES = 1_024  # texts that advance together
SCORED_ROWS = 256
COUNTER_LIMIT = 400_000
BATCH_BYTES = 4 << 20  # of texts that go to a task's Python worker at once
STORED = np.dtype("<i2" if HEAD <= 1 << 15 else "<i4")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def look(token: bytes) -> int:
    """Class of a token outside the head, from its bytes alone."""
    size = min(len(token) // 4, 4)
    last = token[-1]
    return size * 4 + 2 * (not token.isascii()) + (not (97 <= last <= 122 or last > 127))


def text_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of all texts, as ``byte_tokens`` has them, and how many are each text's."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = pc.ascii_split_whitespace(texts)
    # An empty text has one empty piece.
    some = pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
    flat = words.filter(pa.array(some)).flatten()
    return flat.cast(pa.binary()), np.where(some, words.value_lengths().to_numpy(zero_copy_only=False), 0).astype(np.int64)


def looks(tokens: pa.Array) -> np.ndarray:
    """``look`` of each token of a binary array."""
    if not len(tokens):
        return np.zeros(0, np.int64)
    _, offsets, data = tokens.buffers()
    at = np.frombuffer(offsets, np.int32)[tokens.offset : tokens.offset + len(tokens) + 1]
    high = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    at, last = at - at[0], high[at[1:] - at[0] - 1]
    beyond = np.concatenate([[0], np.cumsum(high > 127)])[at]
    letter = ((last >= 97) & (last <= 122)) | (last > 127)
    return np.minimum(np.diff(at) // 4, 4) * 4 + 2 * (np.diff(beyond) > 0) + ~letter


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, c): counts of all tokens of all rows, ends included, added up in the tasks first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, rows = [], 0, 0
        for batch in batches:
            found = pc.value_counts(text_tokens(batch.column(0))[0])
            held.append(pa.table([found.field(0), found.field(1)], names=["token", "c"]))
            size, rows = size + len(found), rows + batch.num_rows
            if size > COUNTER_LIMIT:
                held = [pa.concat_tables(held).group_by("token", use_threads=False).aggregate([("c", "sum")]).rename_columns(["token", "c"])]
                size = held[0].num_rows
                if size > COUNTER_LIMIT // 2:
                    yield from held[0].to_batches()
                    held, size = [], 0
        for rest in held:
            yield from rest.to_batches()
        yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([rows], pa.int64())], names=["token", "c"])

    return docs.select("text").mapInArrow(count, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


class _Places(dict):
    """Places of tokens; look classes as negative numbers for all others, kept up to a bound."""

    def __init__(self, tokens: dict[bytes, int]):
        super().__init__(tokens)
        self.tokens = tokens

    def __missing__(self, token: bytes) -> int:
        if len(self) > len(self.tokens) + LOOKS_KEPT:
            self.clear()
            self.update(self.tokens)
        value = self[token] = -1 - look(token)
        return value


@dataclass
class Model:
    head: dict[bytes, int]  # token -> place, most frequent first
    counts: np.ndarray  # of the head
    total: int
    distinct: int
    # Log shares inside band and look classes: count of the class, and share left for unseen words.
    band_logs: np.ndarray = field(default_factory=lambda: np.zeros(0))
    look_totals: np.ndarray = field(default_factory=lambda: np.zeros(LOOKS))
    look_unseen: np.ndarray = field(default_factory=lambda: np.full(LOOKS, 0.5))
    params: dict[str, np.ndarray] = field(default_factory=dict)
    # Counts of frequent tokens beyond the head. To the network they are of their look class.
    more: dict[bytes, int] = field(default_factory=dict)

    def parts(self) -> dict:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    @cached_property
    def _places(self) -> _Places:
        return _Places(self.head | {token: i for i, token in enumerate(self.more, len(self.head))})

    @cached_property
    def _ids(self) -> np.ndarray:
        """Id of each place; negative places are at its end."""
        more = np.array([-1 - look(token) for token in self.more], np.int32)
        return np.concatenate([np.arange(len(self.head)), more, np.arange(-LOOKS, 0)]).astype(np.int32)

    def known_logs(self) -> tuple[np.ndarray, np.ndarray]:
        """By place: log10 of the base share, and of the share in the look class (0 in the head)."""
        more, looks = np.array(list(self.more.values()), np.float64), -1 - self._ids[len(self.head) : len(self.head) + len(self.more)]
        base = np.log10((np.concatenate([self.counts, more]) + 0.5) / (self.total + 0.5 * (self.distinct + 1)))
        share = np.log10(more / self.look_totals[looks] * (1 - self.look_unseen[looks]))
        return base, np.concatenate([np.zeros(len(self.head)), share])

    @property
    def soft(self) -> int:
        return min(SOFT, len(self.head))

    @property
    def soft_classes(self) -> int:
        return -(-self.soft // CLASS_WORDS)

    @property
    def classes(self) -> int:
        return self.soft_classes + BANDS + LOOKS

    def places(self, tokens: list[bytes]) -> np.ndarray:
        """Places of the tokens and the end, in the head and then in ``more``; look classes as negative numbers."""
        out = np.empty(len(tokens) + 1, np.int32)
        out[:-1] = np.fromiter(map(self._places.__getitem__, tokens), np.int32, len(tokens))
        out[-1] = self.head.get(END, -1)
        return out

    def ids(self, tokens: list[bytes]) -> np.ndarray:
        """Head places; look classes as negative numbers."""
        return self._ids[self.places(tokens)]

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        return self._classes[ids]

    @cached_property
    def _classes(self) -> np.ndarray:
        """Class of each id; negative ids are at its end."""
        ids = np.concatenate([np.arange(len(self.head)), np.arange(-LOOKS, 0)])
        band = self.soft_classes + (np.maximum(ids, 0) - self.soft) * BANDS // max(1, len(self.head) - self.soft)
        out = np.where(ids < self.soft, ids // CLASS_WORDS, np.minimum(band, self.soft_classes + BANDS - 1))
        return np.where(ids < 0, self.soft_classes + BANDS - 1 - ids, out)

    def inputs(self, ids: np.ndarray) -> np.ndarray:
        """Rows of the input embedding: soft words have their own, other tokens that of their class."""
        return self._inputs[ids]

    @cached_property
    def _inputs(self) -> np.ndarray:
        own = self.soft + self._classes
        own[: self.soft] = np.arange(self.soft)
        return own


def build_model(counts: DataFrame) -> Model:
    """Head, classes and shares from the counts of all training tokens."""
    totals = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    top = counts.orderBy(F.col("c").desc(), "token").limit(HEAD).collect()
    model = Model({bytes(r.token): i for i, r in enumerate(top)}, np.array([r.c for r in top], np.float64), totals.n or 0, totals.v)
    # Look classes: what is left of the counts once the head is out.
    head = counts.sparkSession.createDataFrame([(r.token,) for r in top], "token binary")
    rest = counts.where(F.length("token") > 0).join(F.broadcast(head), "token", "left_anti")
    for r in rest.groupBy(look_column(F.col("token")).alias("k")).agg(F.sum("c").alias("n"), F.count_if(F.col("c") == 1).alias("ones")).collect():
        model.look_totals[r.k] = r.n
        model.look_unseen[r.k] = (r.ones + 0.5) / (r.n + 1.0)
    model.more = _frequent(rest, MORE)
    own = model.class_of(np.arange(len(top)))
    sums = np.bincount(own, weights=model.counts, minlength=model.classes)
    model.band_logs = np.log(model.counts / sums[own]) if len(top) else np.zeros(0)
    return model


def init_params(model: Model, seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shape = {
        "embed": (model.soft + model.classes, EMBED), "wx": (EMBED, 3 * HIDDEN), "wh": (HIDDEN, 3 * HIDDEN), "b": (3 * HIDDEN,),
        "cls": (HIDDEN, model.classes), "cls_b": (model.classes,), "out": (model.soft_classes, HIDDEN, CLASS_WORDS),
        "out_b": (model.soft_classes, CLASS_WORDS),
    }
    p = {k: rng.normal(0, 0.1, s).astype(np.float32) for k, s in shape.items()}
    # Start from the counts: class shares, and word shares in their class.
    shares = np.full(model.classes, 0.5)
    shares += np.bincount(model.class_of(np.arange(len(model.head))), weights=model.counts, minlength=model.classes)
    shares[model.soft_classes + BANDS :] += model.look_totals
    p["cls_b"] = np.log(shares / shares.sum()).astype(np.float32)
    p["out_b"] = np.full((model.soft_classes, CLASS_WORDS), -30, np.float32)
    p["out_b"].ravel()[: model.soft] = np.log(model.counts[: model.soft] + 0.5)
    p["cls"] *= 0.1
    p["out"] *= 0.1
    p["b"] *= 0
    return p


def _gates(p: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of input and state and biases, a row per gate sum; signs and factors as ``gru_step`` takes them."""
    scale = np.repeat(np.array([-1, -1, 2], np.float32), HIDDEN)[:, None]
    return p["wx"].T * scale, p["wh"].T * scale, p["b"][:, None] * scale


def _frequent(counts: DataFrame, n: int) -> dict[bytes, int]:
    """Counts of at most ``n`` tokens, all those that reach some count."""
    level = None
    for r in counts.groupBy("c").agg(F.count("*").alias("k")).where("c > 1").orderBy(F.desc("c")).limit(n).collect():
        n -= r.k
        if n < 0:
            break
        level = r.c
    if level is None:
        return {}
    found = counts.where(F.col("c") >= level).select("token", "c").toArrow()
    return dict(zip(found["token"].to_pylist(), found["c"].to_pylist()))


def _columns(rows: int, n: int) -> np.ndarray:
    """Room for ``n`` columns. Rows are a little longer, as rows of a round length would share few lines of the cache."""
    return np.empty((rows, n + 16), np.float32)[:, :n]


def gru_step(gx: np.ndarray, gh: np.ndarray, before: np.ndarray, zr: np.ndarray, n: np.ndarray, after: np.ndarray) -> None:
    """One step of all lanes, which are columns, from the gate sums of inputs and states; fills the last three."""
    np.add(gx[: 2 * HIDDEN], gh[: 2 * HIDDEN], out=zr)
    with np.errstate(over="ignore"):  # 1 / infinity is the 0 it stands for
        np.exp(zr, out=zr)  # the logistic function, of the negative sum
        zr += 1
        np.divide(1, zr, out=zr)
        np.multiply(zr[HIDDEN:], gh[2 * HIDDEN :], out=n)
        n += gx[2 * HIDDEN :]
        np.exp(n, out=n)  # the hyperbolic tangent, of twice the sum
    n += 1
    np.divide(-2, n, out=n)
    n += 1
    np.subtract(before, n, out=after)
    after *= zr[:HIDDEN]
    after += n


def log_probs(model: Model, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural log probability of each token after its state, a column of ``h`` over a row of ones; look tokens give their class alone."""
    cls, ((wc, wo), small) = model.class_of(ids), _output_weights(model.params)
    out = np.empty(len(ids))
    for at in range(0, len(ids), PIECE):
        out[at : at + PIECE] = _log_shares(wc.T @ h[:, at : at + PIECE], cls[at : at + PIECE], small)
    order, runs = _soft_runs(model, ids, cls)
    own, places, found = h[:, order], ids[order] % CLASS_WORDS, np.empty(len(order), np.float32)
    for c, a, b in runs:
        found[a:b] = _log_shares(wo[c].T @ own[:, a:b], places[a:b], small)
    out[order] += found
    band = np.flatnonzero(ids >= model.soft)
    out[band] += model.band_logs[ids[band]]
    return out


def _log_shares(scores: np.ndarray, wanted: np.ndarray, small: bool) -> np.ndarray:
    """Log softmax at ``wanted`` of each column; uses the scores up."""
    if not small:
        scores -= scores.max(axis=0)
    at = scores[wanted, np.arange(len(wanted))]
    return at - np.log(_exp(scores, True).sum(axis=0))


def _soft_runs(model: Model, ids: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Places of the soft words by class, and (class, from, to) of each class there."""
    soft = np.flatnonzero((ids >= 0) & (ids < model.soft))
    own = cls[soft].astype(np.uint8 if model.classes < 256 else np.int64)
    order = np.argsort(own, kind="stable")
    ends = np.cumsum(np.bincount(own, minlength=1)).tolist()
    return soft[order], [(c, a, b) for c, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]


def train(model: Model, docs: list[np.ndarray], *, epochs: int = 2, rate: float = 0.01, seed: int = 11) -> None:
    """Truncated backpropagation: ``LANES`` streams of documents, windows of ``WINDOW`` tokens, states carried on."""
    model.params = init_params(model, seed)
    Descent(model, rate, seed).learn(docs, epochs, LANES)


class Descent:
    """Descent from a model's parameters, which it changes, with moments of its own."""

    def __init__(self, model: Model, rate: float, seed: int = 11):
        self.model, self.rate, self.rng, self.step = model, rate, np.random.default_rng(seed), 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in model.params.items()} for _ in range(2))
        self.scratch: list[np.ndarray] | None = None

    def learn(self, docs: list[np.ndarray], epochs: int, most_lanes: int) -> None:
        """``epochs`` passes over all tokens of the documents."""
        start = self.model.head.get(END, -1)
        for _ in range(epochs):
            stream = np.concatenate([docs[i] for i in self.rng.permutation(len(docs))]) if docs else np.zeros(0, np.int32)
            while len(stream):  # what the lanes leave over follows in fewer lanes
                lanes = min(most_lanes, max(1, len(stream) // (4 * WINDOW)))
                length = len(stream) // lanes
                length -= length % WINDOW if length > WINDOW else 0
                grid, stream = stream[: lanes * length].reshape(lanes, length), stream[lanes * length :]
                # A token's input is the one before it; a document starts with a zero state after an end.
                prior = np.concatenate([np.full((lanes, 1), start, grid.dtype), grid[:, :-1]], axis=1)
                h = np.zeros((HIDDEN, lanes), np.float32)
                for at in range(0, length, WINDOW):
                    h = self._window(prior[:, at : at + WINDOW].T, grid[:, at : at + WINDOW].T, h, start)

    def _window(self, prior: np.ndarray, ys: np.ndarray, h: np.ndarray, start: int) -> np.ndarray:
        """One step of descent on a window (a row per step, a column per lane); the state after it."""
        p, (steps, lanes) = self.model.params, ys.shape
        if self.scratch is None or self.scratch[0].shape[1:] != ys.shape:
            self.scratch = [_columns(HIDDEN + 1, steps * lanes).reshape(-1, steps, lanes), np.empty((EMBED, steps, lanes), np.float32)] + [
                np.empty((steps, k * HIDDEN, lanes), np.float32) for k in (2, 1, 1, 1)] + [np.empty((k * HIDDEN, lanes), np.float32) for k in (3, 3, 4, 1, 1, 1)]
        states, dx, zr, n, befores, of_state, gx, gh, back, dh, kept, left = self.scratch
        states[HIDDEN] = 1  # stands for the biases
        xs, keep = self.model.inputs(prior.ravel()), (prior != start).astype(np.float32)
        x, (wx, wh, b) = p["embed"][xs].reshape(steps, lanes, EMBED), _gates(p)
        for t in range(steps):
            np.matmul(wx, x[t].T, out=gx)
            np.add(gx, b, out=gx)
            np.multiply(h, keep[t], out=befores[t])
            np.matmul(wh, befores[t], out=gh)
            np.multiply(gh[2 * HIDDEN :], np.float32(0.5), out=of_state[t])
            h = states[:HIDDEN, t]
            gru_step(gx, gh, befores[t], zr[t], n[t], h)
        h = h.copy()
        g, dh_out = _output_gradient(self.model, states.reshape(HIDDEN + 1, -1), ys.ravel())
        dh_out = dh_out.reshape(HIDDEN, steps, lanes)
        # Gate sums of the input have the gradients n, z, r, those of the state z, r, n * r.
        dn, dz, dr, dnr = back.reshape(4, HIDDEN, lanes)
        to_input, to_state, wx = back[: 3 * HIDDEN], back[HIDDEN:], np.roll(p["wx"], HIDDEN, axis=1)
        g |= {k: np.zeros_like(p[k]) for k in ("wx", "wh", "b")}
        dh[:] = 0
        for t in reversed(range(steps)):
            z, r, now = zr[t, :HIDDEN], zr[t, HIDDEN:], n[t]
            dh += dh_out[:, t]
            np.multiply(dh, z, out=kept)
            dh -= kept
            np.multiply(now, now, out=left)
            np.subtract(1, left, out=left)
            np.multiply(dh, left, out=dn)
            np.subtract(befores[t], now, out=dz)
            dz *= kept
            np.subtract(1, z, out=left)
            dz *= left
            np.multiply(dn, r, out=dnr)
            np.subtract(1, r, out=dr)
            dr *= dnr
            dr *= of_state[t]
            g["wx"] += (to_input @ x[t]).T
            g["b"] += to_input.sum(axis=1)
            g["wh"] += befores[t] @ to_state.T
            dx[:, t] = wx @ to_input
            np.matmul(p["wh"], to_state, out=dh)
            dh += kept
            dh *= keep[t]
        g["wx"], g["b"] = np.roll(g["wx"], -HIDDEN, axis=1), np.roll(g["b"], -HIDDEN)
        g["embed"] = np.stack([np.bincount(xs, row, len(p["embed"])) for row in dx.reshape(EMBED, -1)], axis=1).astype(np.float32)
        self._descend(g)
        return h

    def _descend(self, g: dict[str, np.ndarray]) -> None:
        self.step += 1
        p, m, v = self.model.params, self.m, self.v
        norm = np.sqrt(sum(float(np.vdot(x, x)) for x in g.values()))
        clip = np.float32(min(1.0, 1.0 / (norm + 1e-9)))
        scale = np.float32(self.rate * np.sqrt(1 - 0.995**self.step) / (1 - 0.9**self.step))
        for k in p:
            d = g[k] * clip
            m[k] += np.float32(0.1) * (d - m[k])
            d *= d
            d -= v[k]
            d *= np.float32(0.005)
            v[k] += d
            np.sqrt(v[k], out=d)
            d += np.float32(1e-6)
            np.divide(m[k], d, out=d)
            d *= scale
            p[k] -= d


def _output_gradient(model: Model, h: np.ndarray, ids: np.ndarray):
    """Gradients of the mean negative log probability for the output weights and the states, which are columns over a row of ones."""
    p, cls, n = model.params, model.class_of(ids), np.float32(len(ids))
    (wc, wo), small = _output_weights(p)
    d_cls, d_out = np.zeros_like(wc), np.zeros_like(wo)
    dh = _columns(HIDDEN, len(ids))
    for at in range(0, len(ids), PIECE):
        part = h[:, at : at + PIECE]
        s = wc.T @ part
        _softmax_error(s, cls[at : at + PIECE], n, small)
        d_cls += part @ s.T
        np.matmul(p["cls"], s, out=dh[:, at : at + PIECE])
    order, runs = _soft_runs(model, ids, cls)
    own, places = h[:, order], ids[order] % CLASS_WORDS
    d_own = np.empty((HIDDEN, len(order)), np.float32)
    for c, a, b in runs:
        w = wo[c].T @ own[:, a:b]
        _softmax_error(w, places[a:b], n, small)
        np.matmul(own[:, a:b], w.T, out=d_out[c])
        np.matmul(p["out"][c], w, out=d_own[:, a:b])
    dh[:, order] += d_own
    return {"cls": d_cls[:HIDDEN], "cls_b": d_cls[HIDDEN], "out": d_out[:, :HIDDEN], "out_b": d_out[:, HIDDEN]}, dh


def _output_weights(p: dict) -> tuple[tuple[np.ndarray, np.ndarray], bool]:
    """Output weights over their biases, for states over a row of ones, and whether no score can leave the range of ``exp``."""
    both = np.concatenate([p["cls"], p["cls_b"][None]]), np.concatenate([p["out"], p["out_b"][:, None]], axis=1)
    return both, all(float(np.abs(x).sum(axis=-2).max(initial=0)) < EXP_RANGE for x in both)


def _exp(scores: np.ndarray, small: bool) -> np.ndarray:
    """In place, up to a factor for each column where scores are not ``small``."""
    if not small:
        scores -= scores.max(axis=0)
    return np.exp(scores, out=scores)


def _softmax_error(scores: np.ndarray, wanted: np.ndarray, n: np.float32, small: bool) -> None:
    """Scores by column become (softmax - one at ``wanted``) / ``n``, in place."""
    _exp(scores, small)
    scores *= 1 / (n * scores.sum(axis=0))
    scores[wanted, np.arange(len(wanted))] -= 1 / n


def train_on_all(training: DataFrame, model: Model) -> None:
    """One pass over every row of ``training`` (``ids``) in the tasks, from the model's parameters; the mean of theirs follows."""
    fixed = {k: v for k, v in model.parts().items() if k not in ("params", "more")}
    shared = training.sparkSession.sparkContext.broadcast(fixed)

    def work(batches: Iterator[pa.RecordBatch], params: dict) -> tuple[dict, float]:
        own, docs, size, seen = Model(**shared.value, params=params), [], 0, 0
        descent = Descent(own, TASK_RATE)
        for batch in batches:
            for ids in _ids_held(batch.column(0)):
                docs.append(ids)
                size += len(ids)
                if size >= TRAIN_BLOCK:
                    descent.learn(docs, 1, TASK_LANES)
                    docs, size, seen = [], 0, seen + size
        descent.learn(docs, 1, TASK_LANES)
        return params, seen + size

    model.params = averaged_round(training.select("ids"), model.params, work)


def score_documents(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each document (ids with the end), its state carried through."""
    order = np.argsort([-len(d) for d in docs], kind="stable")
    out = np.zeros(len(docs))
    for at in range(0, len(docs), SCORED_LANES):
        own = order[at : at + SCORED_LANES]
        out[own] = _score_together(model, [docs[i] for i in own])
    return out


def _score_together(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    """``score_documents`` of documents in falling order of length, so few that the cache holds a step of all."""
    out, sizes = np.zeros(len(docs)), np.array([len(d) for d in docs])
    # Step t of all documents lies together, longest document first.
    active = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    starts = np.concatenate([[0], np.cumsum(active)])
    steps = np.empty(starts[-1], np.int32)
    for k, ids in enumerate(docs):
        steps[starts[: sizes[k]] + k] = ids
    p, h, (wx, wh, b) = model.params, np.zeros((HIDDEN, len(docs)), np.float32), _gates(model.params)
    # A step's inputs are the tokens of the step before; the first are ends.
    inputs = model.inputs(np.concatenate([np.full(len(docs), model.head.get(END, -1), np.int32), steps]))
    before, at = starts[:1].tolist() + (starts[:-1] + len(docs)).tolist(), 0
    while at < len(active):
        # Steps of about SCORED_TOKENS tokens, one at least.
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + SCORED_TOKENS, side="right")) - 1)
        own = np.concatenate([inputs[before[t] : before[t] + active[t]] for t in range(at, end)])
        gx = np.matmul(wx, p["embed"][own].T, out=_columns(3 * HIDDEN, len(own)))
        gx += b
        states, offsets = _columns(HIDDEN + 1, len(own)), (starts[at : end + 1] - starts[at]).tolist()
        states[HIDDEN] = 1
        for a, z in zip(offsets, offsets[1:]):
            last, h = h[:, : z - a], states[:HIDDEN, a:z]
            zr, n = np.empty((2 * HIDDEN, z - a), np.float32), np.empty((HIDDEN, z - a), np.float32)
            gru_step(gx[:, a:z], wh @ last, last, zr, n, h)
        logs = log_probs(model, states, steps[starts[at] : starts[end]])
        places = np.concatenate([np.arange(active[t]) for t in range(at, end)])
        out += np.bincount(places, weights=logs, minlength=len(docs))
        at = end
    return out


PLACED = ("row long, doc_id long, held_out boolean, n_tokens long, n_near long, base_near double, near double, "
          "ids binary, tail_tokens array<binary>, tail_counts array<int>")
SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_near long, base_near double, net double"


def _placed(shared):
    """Per text its ids, the logs of the tokens whose counts are at hand, and the other tokens with their numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = Model(**shared.value)
        base, share = model.known_logs()
        known = pa.array([*model.head, *model.more], pa.binary())
        ids_of, end = model._ids.astype(STORED), model.head.get(END, -1)
        for batch in batches:
            tokens, sizes = text_tokens(batch.column(3))
            n, doc = len(sizes), np.repeat(np.arange(len(sizes)), sizes)
            places = pc.index_in(tokens, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
            near = places >= 0
            far = tokens.filter(pa.array(~near)).dictionary_encode()
            code, width = far.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(1, len(far.dictionary))
            ids = np.empty(len(doc) + n, STORED)
            ends = np.cumsum(sizes + 1)
            inner = np.ones(len(ids), bool)
            inner[ends - 1] = False
            own = ids_of[places]
            own[~near] = -1 - looks(far.dictionary)[code]
            ids[inner], ids[ends - 1] = own, end
            # Each far token once per text.
            pairs, times = np.unique(doc[~near] * width + code, return_counts=True)
            cuts = pa.array(np.searchsorted(pairs, np.arange(n + 1) * width), pa.int32())
            sums = [np.bincount(doc[near], table[places[near]], n) + (table[end] if end >= 0 else 0) for table in (base, share)]
            offsets = np.concatenate([[0], ends * ids.itemsize]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                *[batch.column(i) for i in range(3)], pa.array(sizes + 1, pa.int64()),
                pa.array(np.bincount(doc[near], minlength=n) + (end >= 0), pa.int64()), *map(pa.array, sums),
                pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(ids)]),
                pa.ListArray.from_arrays(cuts, far.dictionary.take(pa.array(pairs % width))),
                pa.ListArray.from_arrays(cuts, pa.array(times, pa.int32())),
            ], names=[x.split()[0] for x in PLACED.split(", ")])

    return run


def _ids_held(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), STORED).astype(np.int32) for x in column]


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = Model(**shared.value)

        def flush():
            held = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            nets = score_documents(model, docs) / np.log(10) + held.column("near").to_numpy()
            rows.clear(), docs.clear()
            names = [x.split()[0] for x in SCORED.split(", ")]
            return pa.RecordBatch.from_arrays([*[held.column(x) for x in names[:-1]], pa.array(nets)], names=names)

        rows, docs, size = [], [], 0
        for batch in (b.slice(at, SCORED_ROWS) for b in batches for at in range(0, b.num_rows, SCORED_ROWS)):
            docs += _ids_held(batch.column("ids"))
            rows.append(batch.drop_columns(["ids"]))
            size += sum(map(len, docs[len(docs) - batch.num_rows :]))
            if size >= BLOCK_TOKENS:
                yield flush()
                size = 0
        if rows:
            yield flush()

    return run


def score_corpus(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    training = docs.where(~F.col("held_out"))
    with batches_of(spark, BATCH_BYTES):
        counts = materialize(token_counts(training), "token-counts")
    model = build_model(counts)
    sample = bounded_sample(training, "doc_id", START_DOCS).select("text")
    texts, size = [], 0
    for row in sample.toLocalIterator():
        if size < START_TOKENS:
            texts.append(model.ids(byte_tokens(row.text)))
            size += len(texts[-1])
    train(model, texts)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    with batches_of(spark, BATCH_BYTES):
        placed = materialize(rows.mapInArrow(_placed(spark.sparkContext.broadcast(model.parts())), PLACED), "token-places")
    train_on_all(placed.where(~F.col("held_out")), model)
    shared = spark.sparkContext.broadcast({k: v for k, v in model.parts().items() if k != "more"})
    own = placed.select("row", "doc_id", "held_out", "n_tokens", "n_near", "base_near", "near", "ids")
    scored = materialize(own.mapInArrow(_scorer(shared), SCORED), "network-scores")
    spread = float(model.total + 0.5 * (model.distinct + 1))
    tail = placed.select("row", F.explode(F.arrays_zip("tail_tokens", "tail_counts")).alias("t")).select(
        "row", F.col("t.tail_tokens").alias("token"), F.col("t.tail_counts").alias("k"))
    met = tail.join(counts.hint("shuffle_hash"), "token", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    totals, unseen = (F.array(*(F.lit(float(x)) for x in a)) for a in (model.look_totals, model.look_unseen))
    place = look_column(F.col("token"))
    gap = F.get(unseen, place)
    share = F.when(F.col("c") == 0, F.log10(gap)).otherwise(F.log10(F.col("c") / F.get(totals, place) * (1 - gap)))
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("known"),
        F.sum(F.col("k") * F.log10((F.col("c") + 0.5) / spread)).alias("base"), F.sum(F.col("k") * share).alias("own"),
    )
    zero = F.lit(0.0)
    return scored.join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_near") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"), (F.col("base_near") + F.coalesce("base", zero)).alias("base_score"),
        (F.col("net") + F.coalesce("own", zero)).alias("score"),
    )


def look_column(token: Column) -> Column:
    """``look`` of a binary column in built-in functions."""
    size = F.least(F.floor(F.length(token) / 4), F.lit(4))
    last = F.conv(F.hex(F.substring(token, -1, 1)), 16, 10).cast("int")
    ascii_ = ~F.hex(token).rlike("^(..)*[89A-F].")
    letter = last.between(97, 122) | (last > 127)
    return (size * 4 + F.when(ascii_, 0).otherwise(2) + F.when(letter, 0).otherwise(1)).cast("int")
