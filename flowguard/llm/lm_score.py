"""Language-model scores: a causal self-attention model in numpy on subword ids.

Tokens of a text: its words (A-Z lower-cased, ``[^\\x20\\x09-\\x0D]+``), then one end. A word's
subwords come from a public tokenizer file (a parameter; its bytes are broadcast); the most frequent
pieces of the training texts and all single bytes form the model's ids, so any word can be spelled.

Model: one layer of causal attention with a learned bias per distance, a feed-forward layer, and an
output in two steps (class, member of the class) with biases by the previous id. Ids that begin a
word have their own classes, so the probability that a word ends is known at each place and the
probability of each word is exact: words' probabilities over all possible next words add up to 1.
Texts are cut into overlapping windows; the first ``CONTEXT`` places of a later window are context
alone, so each token is scored once, in batches, under the causal mask.

Score: log10 of the probability of the text under an equal mixture of experts: the attention model
alone, and absolutely discounted word counts (of all training texts, and of each of ``TOPICS`` groups
of them with like bytes) whose withheld mass goes to words by their attention probability. Each is a
proper distribution over texts, and so is the mixture.

Counts: texts are dealt once by hash into blocks of about ``BLOCK_BYTES``; a block sends one row per
distinct word, a window over the word adds up training counts (a word in every text is one row per
block), and the counts return to the blocks, where base and model scores are computed.

Training takes all texts that aren't held out. They are spelled in pieces once and stored; pieces are
counted over all of them, k-means passes read all their byte shapes, and the model visits every window:
texts are dealt by hash into parts of about ``PART_BYTES`` and these into at most ``ROUNDS`` rounds. In
a round each part runs Adam from the same state on windows in a random order, and the mean of the
states, weighted by windows, is the next one (averaged piece by piece on executors; the driver gets one
state). Small tables are passed over until some ``STEPS`` batches were seen. Parts, orders and sums are
fixed by hashes, so a rerun gives the same model. Cases: null or empty text: one token, the end. Without training texts the counts are 0
(base 0 per token) and the model stays at its random start. Null doc_ids are not held out. Repeated
rows stay rows and count as often; extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowguard.llm.common import NOT_SPACE, Words, discard, give_back, keep_memory, mix, ready, slices, store
from flowguard.llm.labelled import held_out

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_BYTES = 6 << 20
#: Text of one part of a training round (one task's work), and rounds of a pass over all texts.
PART_BYTES, ROUNDS = 4 << 20, 8
CLASSES = SIZE = 32  # ids = classes x members
DIM, HIDDEN = 16, 32
WINDOW, CONTEXT = 32, 8
#: Windows scored at once: small enough for a core's cache.
TOGETHER = 48
#: Batches of windows that training sees at least, and windows of a batch.
STEPS, BATCH = 3000, 64
TOPICS = 4
DISCOUNT = 0.75
END = 0
#: The end's place among the 64-bit word hashes.
END_WORD = np.uint64(0)


# ----------------------------------------------------------------------------------- vocabulary


def tokenizer_of(proto: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=proto)


class Vocabulary:
    """Words to model ids. Id 0 is the end, id 1 the bare word start; further ids that begin a word
    fill the first classes, ids inside a word the others (256 bytes among them). ``first``, ``inner``:
    how often each piece of the tokenizer begins a word, and stands inside one."""

    def __init__(self, proto: bytes, first: np.ndarray, inner: np.ndarray):
        self.proto = proto
        sp = tokenizer_of(proto)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        plain = lambda i: not sp.is_byte(i) and not sp.is_unknown(i) and not sp.is_control(i)
        heads = [i for i in range(len(pieces)) if first[i] and plain(i) and pieces[i].startswith("▁") and pieces[i] != "▁"]
        tails = [i for i in range(len(pieces)) if inner[i] and plain(i) and "▁" not in pieces[i]]
        room = CLASSES * SIZE - 258
        ranked = sorted([(-first[i], 0, i) for i in heads] + [(-inner[i], 1, i) for i in tails])[:room]
        head = [i for _, k, i in ranked if k == 0]
        tail = [i for _, k, i in ranked if k == 1]
        self.start_classes = min(-(-(len(head) + 2) // SIZE), CLASSES - 8)
        head = head[: self.start_classes * SIZE - 2]
        tail = tail[: (CLASSES - self.start_classes) * SIZE - 256]
        base = self.start_classes * SIZE
        order = [("p", i) for i in tail] + [("b", b) for b in range(256)]  # frequent ids share classes
        self.byte_id = {b: base + k for k, (t, b) in enumerate(order) if t == "b"}
        tail_id = {i: base + k for k, (t, i) in enumerate(order) if t == "p"}
        head_id = {i: 2 + k for k, i in enumerate(head)}
        spell = lambda s: [self.byte_id[b] for b in s.encode()]
        self.lists: tuple[list, list] = ([], [])
        for i, piece in enumerate(pieces):
            if sp.is_byte(i):
                own = [self.byte_id[int(piece[3:5], 16)]]
                lead = [1, *own]
            else:
                own = [tail_id[i]] if i in tail_id else spell(piece.replace("▁", " "))
                lead = [head_id[i]] if i in head_id else [1, *(spell(piece[1:]) if piece.startswith("▁") else own)]
            self.lists[0].append(lead)
            self.lists[1].append(own)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, n+1 offsets)."""
        if not hasattr(self, "_sp"):
            self._sp = tokenizer_of(self.proto)
        lead, own = self.lists
        flat: list[int] = []
        size = []
        for word, ids in zip(words, self._sp.encode(words, num_threads=1), strict=True):
            n = len(flat)
            if ids:
                flat += lead[ids[0]]
                for i in ids[1:]:
                    flat += own[i]
            else:  # nothing the tokenizer keeps: spelled in bytes
                flat.append(1)
                flat += [self.byte_id[b] for b in word.encode()]
            size.append(len(flat) - n)
        return np.array(flat, np.int32), np.concatenate([[0], np.cumsum(size)]).astype(np.int64)

    def texts(self, pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, n+1 offsets) of texts spelled in pieces (see ``spell_texts``), each with its end."""
        table = [*self.lists[1], *self.lists[0], [END]]
        size = np.array([len(t) for t in table])
        begin, ids = np.cumsum(size) - size, np.array(list(chain.from_iterable(table)), np.int32)
        many = len(self.lists[1])
        rows = []
        for p in pieces:
            begins = p >= begins_word(p.dtype)
            rows += [np.where(begins, p.astype(np.int64) - begins_word(p.dtype) + many, p), [2 * many]]
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        at = np.concatenate([[0], np.cumsum(size[flat])])
        ends = np.cumsum([0, *(len(p) + 1 for p in pieces)])
        return ids[np.repeat(begin[flat] - at[:-1], size[flat]) + np.arange(at[-1])], at[ends]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_sp"}


# ---------------------------------------------------------------------------------------- model

SHAPES = {
    "E": (CLASSES * SIZE, DIM), "QKV": (DIM, 3 * DIM), "O": (DIM, DIM), "R": (WINDOW,), "W1": (DIM, HIDDEN), "b1": (HIDDEN,), "W2": (HIDDEN, DIM),
    "Wc": (DIM, CLASSES), "Wm": (DIM, SIZE), "Bc": (CLASSES * SIZE, CLASSES), "Bm": (CLASSES * SIZE, SIZE), "U": (CLASSES, SIZE),
}
_I, _J = np.indices((WINDOW, WINDOW))
_MASK = np.where(_J <= _I, 0, -1e9).astype(np.float32)
_DIST = np.maximum(_I - _J, 0)


def fresh(seed: int = 0) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    p = {k: r.normal(size=s) * (0.3 if k == "E" else 1 / np.sqrt(s[0])) for k, s in SHAPES.items()}
    for k in ("R", "b1", "Bc", "Bm", "U"):
        p[k][...] = 0
    return {k: v.astype(np.float32) for k, v in p.items()}


def softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(-1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(-1, keepdims=True)
    return z


def hidden(p: dict, ids: np.ndarray) -> tuple:
    """Last hidden states of windows of ids (n, WINDOW), and what the gradient needs."""
    n = len(ids)
    x = p["E"][ids]
    qkv = (x.reshape(-1, DIM) @ p["QKV"]).reshape(n, WINDOW, 3 * DIM)
    q, k, v = qkv[..., :DIM], qkv[..., DIM : 2 * DIM], qkv[..., 2 * DIM :]
    s = np.matmul(q, k.transpose(0, 2, 1))
    s *= np.float32(1 / np.sqrt(DIM))
    s += p["R"][_DIST] + _MASK
    a = softmax(s)
    c = np.matmul(a, v)
    h1 = x + (c.reshape(-1, DIM) @ p["O"]).reshape(x.shape)
    r = np.maximum(h1.reshape(-1, DIM) @ p["W1"] + p["b1"], 0)
    h = h1.reshape(-1, DIM) + r @ p["W2"]
    return h, (x, q, k, v, a, c, h1, r)


def scoring_form(p: dict, start_classes: int) -> dict[str, np.ndarray]:
    """The weights as scoring uses them: each id's query, key and value by table (the value with a
    one beside it, so that its average also gives the softmax's sum), both outputs side by side, and
    the columns that add up exponentials to class, member and word-start totals."""
    w = p["QKV"].copy()
    w[:, :DIM] /= np.sqrt(DIM)
    qkv = p["E"] @ w
    sums = np.zeros((CLASSES + SIZE, 3), np.float32)
    sums[:CLASSES, 0] = sums[CLASSES:, 1] = sums[:start_classes, 2] = 1
    form = {
        "E": p["E"], "QK": qkv[:, : 2 * DIM], "V": np.concatenate([qkv[:, 2 * DIM :], np.ones((len(qkv), 1))], 1), "M": _MASK + p["R"][_DIST], "O": p["O"], "W1": p["W1"], "b1": p["b1"],
        "W2": p["W2"], "W": np.concatenate([p["Wc"], p["Wm"]], 1), "B": np.concatenate([p["Bc"], p["Bm"]], 1), "U": p["U"], "S": sums,
    }
    return {k: np.ascontiguousarray(v, np.float32) for k, v in form.items()}


def window_probabilities(form: dict, ids: np.ndarray, targets: np.ndarray, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Natural log of each target's probability, and of the probability that a word (or the end)
    begins there; shapes (n, WINDOW - skip). The first ``skip`` places are read as context only: with
    one layer nothing else depends on their outputs. Logits are small, so exponentials need no shift."""
    n, flat, t = len(ids), ids.ravel(), targets[:, skip:].ravel()
    qk = np.take(form["QK"], flat, 0).reshape(n, WINDOW, 2 * DIM)
    a = np.matmul(qk[:, skip:, :DIM], qk[..., DIM:].transpose(0, 2, 1))
    a += form["M"][skip:]
    np.exp(a, out=a)
    c = np.matmul(a, np.take(form["V"], flat, 0).reshape(n, WINDOW, DIM + 1)).reshape(-1, DIM + 1)
    flat = ids[:, skip:].ravel()
    h = (c[:, :DIM] / c[:, DIM:]) @ form["O"]
    h += np.take(form["E"], flat, 0)
    r = h @ form["W1"]
    r += form["b1"]
    np.maximum(r, 0, out=r)
    h += r @ form["W2"]
    z = h @ form["W"]
    z += np.take(form["B"], flat, 0)
    kind = t // SIZE
    z[:, CLASSES:] += np.take(form["U"], kind, 0)
    rows = np.arange(len(t))
    own = z[rows, kind] + z[rows, CLASSES + t % SIZE]
    np.exp(z, out=z)
    total = z @ form["S"]
    begin = np.log(total[:, 2] / total[:, 0])
    own -= np.log(total[:, 0] * total[:, 1])
    return own.reshape(n, WINDOW - skip), begin.reshape(n, WINDOW - skip)


def gradients(p: dict, ids: np.ndarray, targets: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
    """Weighted mean loss of a batch of windows and its gradient."""
    h, (x, q, k, v, a, c, h1, r) = hidden(p, ids)
    flat, t, w = ids.ravel(), targets.ravel(), weight.ravel().astype(np.float32)
    w = w / max(w.sum(), 1)
    rows = np.arange(len(t))
    pc = softmax(h @ p["Wc"] + p["Bc"][flat])
    pm = softmax(h @ p["Wm"] + p["Bm"][flat] + p["U"][t // SIZE])
    loss = -float((w * (np.log(pc[rows, t // SIZE] + 1e-20) + np.log(pm[rows, t % SIZE] + 1e-20))).sum())
    dc, dm = pc, pm
    dc[rows, t // SIZE] -= 1
    dm[rows, t % SIZE] -= 1
    dc *= w[:, None]
    dm *= w[:, None]
    g = {n: np.zeros_like(m) for n, m in p.items()}
    g["Wc"], g["Wm"] = h.T @ dc, h.T @ dm
    g["U"] = (np.arange(CLASSES)[:, None] == t // SIZE).astype(dm.dtype) @ dm
    dh = dc @ p["Wc"].T + dm @ p["Wm"].T
    g["W2"] = r.T @ dh
    dr = (dh @ p["W2"].T) * (r > 0)
    g["W1"], g["b1"] = h1.reshape(-1, DIM).T @ dr, dr.sum(0)
    dh1 = dh + dr @ p["W1"].T
    g["O"] = c.reshape(-1, DIM).T @ dh1
    dcx = (dh1 @ p["O"].T).reshape(c.shape)
    da = np.matmul(dcx, v.transpose(0, 2, 1))
    dv = np.matmul(a.transpose(0, 2, 1), dcx)
    ds = a * (da - (da * a).sum(-1, keepdims=True))
    g["R"] = np.bincount(_DIST.ravel(), (ds.sum(0) * (_MASK == 0)).ravel(), WINDOW).astype(np.float32)
    ds *= np.float32(1 / np.sqrt(DIM))
    dqkv = np.concatenate([np.matmul(ds, k), np.matmul(ds.transpose(0, 2, 1), q), dv], -1).reshape(-1, 3 * DIM)
    g["QKV"] = x.reshape(-1, DIM).T @ dqkv
    # sums by input id of three tables at once
    both = np.concatenate([dc, dm, dh1 + dqkv @ p["QKV"].T], 1)
    wide = both.shape[1]
    sums = np.zeros(CLASSES * SIZE * wide, both.dtype)
    np.add.at(sums, (flat[:, None].astype(np.int64) * wide + np.arange(wide)).ravel(), both.ravel())
    g["Bc"], g["Bm"], g["E"] = np.split(sums.reshape(-1, wide), [CLASSES, CLASSES + SIZE], 1)
    return loss, g


def window_starts(first: np.ndarray, context: int = CONTEXT) -> tuple[np.ndarray, np.ndarray]:
    """(document, number in it) of each window."""
    size = np.diff(first)
    many = np.where(size > 0, 1 + np.maximum(0, -(-(size - WINDOW) // (WINDOW - context))), 0)
    doc = np.repeat(np.arange(len(size)), many)
    return doc, np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


def windows_at(ids: np.ndarray, first: np.ndarray, doc: np.ndarray, number: np.ndarray, context: int = CONTEXT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    begin = first[:-1][doc] + number * (WINDOW - context)
    at = begin[:, None] + np.arange(WINDOW)[None, :]
    inside = at < first[1:][doc][:, None]
    safe = np.minimum(at, max(len(ids) - 1, 0))
    targets = np.where(inside, ids[safe], END)
    inputs = np.where(at > first[:-1][doc][:, None], ids[np.maximum(safe - 1, 0)], END)
    scored = inside & ((number == 0)[:, None] | (np.arange(WINDOW) >= context)[None, :])
    return np.where(inside, inputs, END).astype(np.int32), targets.astype(np.int32), np.where(scored, at, -1)


def windows_of(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows of documents whose ids (each ending with END) lie at first[d]:first[d+1].

    Returns (inputs, targets, place of each target in ``ids`` or -1 if it isn't scored there). A
    place's input is the id before it (END before the first)."""
    return windows_at(ids, first, *window_starts(first))


#: A training state as one row of numbers: weights, both moments, steps done.
WEIGHTS = sum(int(np.prod(s)) for s in SHAPES.values())


def parts_of(row: np.ndarray) -> dict[str, np.ndarray]:
    """Weights (or moments) by name, as views of a row."""
    at = np.cumsum([0, *(int(np.prod(s)) for s in SHAPES.values())])
    return {k: row[at[i] : at[i + 1]].reshape(s) for i, (k, s) in enumerate(SHAPES.items())}


def fresh_state(seed: int = 0) -> np.ndarray:
    state = np.zeros(3 * WEIGHTS + 1, np.float32)
    state[:WEIGHTS] = np.concatenate([v.ravel() for v in fresh(seed).values()])
    return state


def train(state: np.ndarray, ids: np.ndarray, first: np.ndarray, seed: int, share: tuple[float, float] = (0, 1), passes: int = 1, rate: float = 0.012) -> tuple[np.ndarray, int]:
    """(state after Adam over all windows, ``passes`` times in random orders; number of windows);
    deterministic. Windows don't overlap here: each id is learned once a pass. share: the part of the
    whole training that this is, for the pace."""
    keep_memory()
    state = state.copy()
    p = parts_of(state[:WEIGHTS])
    weights, mean, square = state[: 3 * WEIGHTS].reshape(3, WEIGHTS)
    doc, number = window_starts(first, 0)
    rng = np.random.default_rng(seed)
    t, total = int(state[-1]), max(1, passes * -(-len(doc) // BATCH))
    done = 0
    for _ in range(passes):
        order = rng.permutation(len(doc))
        for k in range(0, len(order), BATCH):
            pick = order[k : k + BATCH]
            inputs, targets, place = windows_at(ids, first, doc[pick], number[pick], 0)
            g = np.concatenate([m.ravel() for m in gradients(p, inputs, targets, place >= 0)[1].values()])
            t, done = t + 1, done + 1
            pace = rate * min(1, t / 50) * (1 - 0.95 * (share[0] + (share[1] - share[0]) * done / total))
            mean += np.float32(0.1) * (g - mean)
            g *= g
            square += np.float32(0.01) * (g - square)
            weights -= np.float32(pace / (1 - 0.9**t)) * mean / (np.sqrt(square / np.float32(1 - 0.99**t)) + np.float32(1e-7))
    state[-1] = t
    return state, len(doc)


def byte_shapes(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Square roots of the frequencies of letters and bytes above ASCII in each text (documents x
    256), so that what a text is written in weighs more than how it is laid out."""
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    count = np.bincount(doc * 256 + data, minlength=(len(off) - 1) * 256).reshape(-1, 256).astype(float)
    count[:, ~_LETTERS] = 0
    return np.sqrt(count / np.maximum(count.sum(1, keepdims=True), 1))


_LETTERS = np.zeros(256, bool)
_LETTERS[97:123] = _LETTERS[128:] = True


def topic_of(shapes: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1)[None, :] - 2 * shapes @ centres.T).argmin(1)


@dataclass
class Model:
    vocabulary: Vocabulary
    weights: dict[str, np.ndarray]
    centres: np.ndarray


def token_logs(model: Model, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each id: natural log of its probability, and of a word's beginning at its place."""
    form = scoring_form(model.weights, model.vocabulary.start_classes)
    logs, begins = np.zeros(len(ids), np.float32), np.zeros(len(ids), np.float32)
    # documents in ranges of about 100,000 ids, so that memory follows the range
    at = 0
    while at < len(first) - 1:
        to = max(at + 1, int(np.searchsorted(first, first[at] + 100_000, "right")) - 1)
        low = first[at]
        inputs, targets, place = windows_of(ids[low : first[to]], first[at : to + 1] - low)
        later = place[:, 0] < 0  # their first CONTEXT places are context alone
        for which, skip in ((np.flatnonzero(~later), 0), (np.flatnonzero(later), CONTEXT)):
            for k in range(0, len(which), TOGETHER):
                some = which[k : k + TOGETHER]
                a, b = window_probabilities(form, inputs[some], targets[some], skip)
                where = place[some, skip:]
                ok = where >= 0
                logs[low + where[ok]] = a[ok]
                begins[low + where[ok]] = b[ok]
        at = to
    return logs, begins


def spelled(which: np.ndarray, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Model ids of a row of tokens (distinct words, -1: end), and the n+1 places where each begins."""
    size = np.append(np.diff(off), 1)[which]  # -1 takes the last: the end
    at = np.concatenate([[0], np.cumsum(size)])
    begin = np.append(off[:-1], len(ids))[which]
    source = np.repeat(begin - at[:-1], size) + np.arange(at[-1])
    return np.append(ids, END)[source], at


def word_logs(model: Model, which: np.ndarray, ids: np.ndarray, off: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Natural log probability of each token of consecutive documents (words, then an end each).

    which: distinct word of each token (-1: end); ids, off: ids of the distinct words; count: tokens
    per document. A word has its ids' probabilities, given that a word begins, times the probability
    that another (or the end) begins after it."""
    flat, token_at = spelled(which, ids, off)
    doc_end = np.cumsum(count)
    first = token_at[np.concatenate([[0], doc_end])]
    logs, begins = token_logs(model, flat, first)
    total = np.concatenate([[0.0], np.cumsum(logs, dtype=np.float64)])
    own = total[token_at[1:]] - total[token_at[:-1]] - begins[token_at[:-1]]
    after = np.zeros(len(which))
    after[:-1] = begins[token_at[1:-1]]
    after[doc_end - 1] = 0
    return own + after


# ------------------------------------------------------------------------------------ Spark side


def tokens_of(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of texts; hash of each (never the end's); distinct hashes and the number of each word."""
    w = Words(texts, NOT_SPACE)
    h = w.hashes()
    h[h == END_WORD] = 1
    return w, h, np.unique(h, return_inverse=True)


def word_strings(w: Words, at: np.ndarray) -> list[str]:
    raw = w.low.tobytes()
    return [raw[s:e].decode() for s, e in zip(w.start[at].tolist(), w.end[at].tolist(), strict=True)]


def begins_word(kind: np.dtype) -> int:
    """The bit of a stored piece that says that it begins a word."""
    return 1 << (8 * kind.itemsize - 1)


def pieces_of(sp, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(pieces of all words, n+1 offsets). Words of which the tokenizer keeps nothing are spelled by
    the bare word start and its byte pieces."""
    lists = sp.encode(words, num_threads=1)
    empty = [k for k, ids in enumerate(lists) if not ids]
    if empty:
        byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(sp.get_piece_size()) if sp.is_byte(i)}
        for k in empty:
            lists[k] = [sp.piece_to_id("▁"), *(byte[b] for b in words[k].encode() if b in byte)]
    off = np.concatenate([[0], np.cumsum([len(ids) for ids in lists], dtype=np.int64)])
    return np.fromiter(chain.from_iterable(lists), np.int64, off[-1]), off


TRAINING = "part int, round int, k long, pieces binary, shape binary"


def spell_texts(docs: DataFrame, proto: Broadcast) -> DataFrame:
    """``TRAINING``, stored: every text that isn't held out, dealt by the hash ``k``, in pieces of the
    tokenizer (16 or 32 bits each, the highest says that it begins a word), and its byte shape."""
    rows = docs.where(~held_out(of=10)).select(F.xxhash64("doc_id", "text").alias("k"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = (rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0) // PART_BYTES + 1
    part = F.pmod(F.xxhash64("k", F.lit(7)), F.lit(parts)).cast("int")
    dealt = rows.select(part.alias("part"), (part % F.lit(min(parts, ROUNDS))).cast("int").alias("round"), "k", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = tokenizer_of(proto.value)
        kind = np.dtype(np.uint16 if sp.get_piece_size() <= 1 << 15 else np.uint32)
        for batch in batches:
            for some in slices(batch, "text"):
                w, _, (word, number) = tokens_of(some.column(3))
                seen = np.full(len(word), len(number))
                np.minimum.at(seen, number, np.arange(len(number)))
                flat, off = pieces_of(sp, word_strings(w, seen)) if len(word) else (np.zeros(0, np.int64), np.zeros(1, np.int64))
                flat[off[:-1]] |= begins_word(kind)
                size = np.diff(off)[number]
                at = np.concatenate([[0], np.cumsum(size)])
                flat = flat[np.repeat(off[:-1][number] - at[:-1], size) + np.arange(at[-1])].astype(kind)
                blobs = [flat[s:e].tobytes() for s, e in zip(at[w.first[:-1]].tolist(), at[w.first[1:]].tolist(), strict=True)]
                shapes = np.rint(byte_shapes(w.low, w.off)[:, _LETTERS] * SHAPE_ONE).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:3], pa.array(blobs, pa.binary()), pa.array([r.tobytes() for r in shapes], pa.binary())], ["part", "round", "k", "pieces", "shape"]
                )

    return store(dealt.mapInArrow(run, TRAINING), "lm-training")


def totals(rows: DataFrame) -> dict[int, np.ndarray]:
    """Rows ``name int, numbers binary`` (64-bit integers), added up by name."""

    def run(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(b.as_buffer(), np.int64) for b in table.column("numbers")], 0)
        return pa.table([table.column("name").slice(0, 1), pa.array([total.tobytes()], pa.binary())], ["name", "numbers"])

    return {r.name: np.frombuffer(r.numbers, np.int64) for r in rows.groupBy("name").applyInArrow(run, rows.schema).collect()}


def named(rows: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), pa.array([v.astype(np.int64).tobytes() for v in rows.values()], pa.binary())], ["name", "numbers"])


def piece_counts(training: DataFrame, pieces: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each piece begins a word, and stands inside one, in all training texts."""
    kind = np.dtype(np.uint16 if pieces <= 1 << 15 else np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((2, pieces), np.int64)
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column(0).to_pylist()), kind)
            begins = flat >= begins_word(kind)
            for k, some in enumerate((flat[begins] - begins_word(kind), flat[~begins])):
                own[k] += np.bincount(some, minlength=pieces)
        yield named({0: own[0], 1: own[1]})

    got = totals(training.select("pieces").mapInArrow(run, "name int, numbers binary"))
    return tuple(got.get(k, np.zeros(pieces, np.int64)) for k in (0, 1))


#: Byte shapes are kept as multiples of this, so that their sums don't depend on the order.
SHAPE_ONE = 1 << 15
#: What no text is near to: the centre of a group that stays empty.
FAR = 9.0


def topic_centres(training: DataFrame, topics: int = TOPICS, tries: int = 12, rounds: int = 15) -> np.ndarray:
    """k-means over the shapes of all training texts with spread starts, the best of several;
    deterministic. The tries run side by side: each pass over the stored shapes serves all of them.

    A start is drawn with a chance by its squared distance from the nearest start before: of all
    texts the one with the least -log(u) / distance, u being a hash of the text and the try."""
    width = int(_LETTERS.sum())
    shapes_of = lambda batch: np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, width)

    def distances(q: np.ndarray, centres: np.ndarray) -> np.ndarray:
        """texts x tries x centres"""
        x, c = q / SHAPE_ONE, centres.reshape(-1, width)
        d = (x**2).sum(1)[:, None] + (c**2).sum(1)[None, :] - 2 * x @ c.T
        return np.maximum(d, 0).reshape(len(q), tries, -1)

    def start(centres: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                k, q = batch.column(0).to_numpy().view(np.uint64), shapes_of(batch)
                if not len(k):
                    continue
                salt = np.arange(1, tries + 1, dtype=np.uint64) * np.uint64(1000) + np.uint64(centres.shape[1])
                u = ((mix(k[:, None] ^ mix(salt)[None, :]) >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
                near = distances(q, centres).min(2) if centres.shape[1] else np.ones(u.shape)
                key = np.where(near > 1e-12, -np.log(u) / np.maximum(near, 1e-12), np.inf)
                best = key.argmin(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(tries, dtype=np.int32)), pa.array(key.min(0)), pa.array(k[best].view(np.int64)), pa.array([q[b].tobytes() for b in best], pa.binary())], ["try", "key", "k", "shape"]
                )

        rows = training.select("k", "shape").mapInArrow(run, "try int, key double, k long, shape binary").where(F.col("key") < float("inf"))
        next_ = np.full((tries, 1, width), FAR)
        for r in rows.groupBy("try").agg(F.min(F.struct("key", "k", "shape")).alias("b")).collect():
            next_[r["try"], 0] = np.frombuffer(r.b["shape"], np.uint16) / SHAPE_ONE
        return np.concatenate([centres, next_], 1)

    def step(centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The centres' texts' means, and each try's loss (in whole millionths a text)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = np.zeros((tries, topics, width + 1), np.int64)
            loss = np.zeros(tries, np.int64)
            for batch in batches:
                q = shapes_of(batch)
                d = distances(q, centres)
                loss += np.rint(d.min(2) * 1e6).astype(np.int64).sum(0)
                member = d.argmin(2)[:, :, None] == np.arange(topics)
                one = np.concatenate([q, np.ones((len(q), 1))], 1)  # whole numbers below 2**53: exact in any order
                own += (member.reshape(len(q), -1).T.astype(float) @ one).astype(np.int64).reshape(own.shape)
            yield named({k: np.append(own[k].ravel(), loss[k]) for k in range(tries)})

        got = totals(training.select("k", "shape").mapInArrow(run, "name int, numbers binary"))
        out, losses = centres.copy(), np.zeros(tries)
        for k, numbers in got.items():
            sums, losses[k] = numbers[:-1].reshape(topics, width + 1), numbers[-1]
            there = sums[:, -1] > 0
            out[k, there] = sums[there, :-1] / sums[there, -1:] / SHAPE_ONE
        return out, losses

    centres = np.zeros((tries, 0, width))
    for _ in range(topics):
        centres = start(centres)
    for _ in range(rounds):
        moved, losses = step(centres)
        if (moved == centres).all():
            break
        centres = moved
    else:
        _, losses = step(centres)
    out = np.zeros((topics, 256))
    out[:, _LETTERS] = centres[int(losses.argmin())]
    return out


#: Pieces of a state that are averaged apart.
CHUNKS = 16


def trained(training: DataFrame, vocabulary: Vocabulary, pieces: int, seed: int = 0) -> dict[str, np.ndarray]:
    """The model's weights after all windows of all training texts (``pieces`` in all)."""
    spark = training.sparkSession
    parts = {r["round"]: r.n for r in training.groupBy("round").agg(F.count_distinct("part").alias("n")).collect()}  # ROUNDS rows
    passes = max(1, -(-STEPS * BATCH * WINDOW // max(pieces, 1)))
    passes = min(passes, STEPS)  # a table of a few words: a batch a pass
    state = fresh_state(seed)
    many = len(vocabulary.lists[0])
    kind = np.dtype(np.uint16 if many <= 1 << 15 else np.uint32)
    words = spark.sparkContext.broadcast(vocabulary)
    bounds = np.linspace(0, len(state), CHUNKS + 1).astype(int)
    for number, r in enumerate(sorted(parts)):
        shared = spark.sparkContext.broadcast(state)
        share = (number / len(parts), (number + 1) / len(parts))

        def run(table: pa.Table) -> pa.Table:
            table = table.sort_by("k")  # equal hashes: equal texts
            ids, first = words.value.texts([np.frombuffer(b.as_buffer(), kind) for b in table.column("pieces")])
            part = table.column("part")[0].as_py()
            after, windows = train(shared.value, ids, first, seed * 1_000_003 + part, share, passes)
            give_back()
            blobs = [after[s:e].tobytes() for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
            return pa.table([pa.array(range(CHUNKS), pa.int32()), pa.array([part] * CHUNKS, pa.int32()), pa.array([windows] * CHUNKS, pa.int64()), pa.array(blobs, pa.binary())], ["chunk", "part", "windows", "numbers"])

        def mean(table: pa.Table) -> pa.Table:
            table = table.sort_by("part")
            weight = table.column("windows").to_numpy().astype(float)
            total = sum(w * np.frombuffer(b.as_buffer(), np.float32).astype(float) for w, b in zip(weight, table.column("numbers"), strict=True))
            return pa.table([table.column("chunk").slice(0, 1), pa.array([(total / weight.sum()).astype(np.float32).tobytes()], pa.binary())], ["chunk", "numbers"])

        rows = training.where(F.col("round") == r).select("part", "k", "pieces").repartition(2 * parts[r], "part")
        after = rows.groupBy("part").applyInArrow(run, "chunk int, part int, windows long, numbers binary")
        got = after.groupBy("chunk").applyInArrow(mean, "chunk int, numbers binary").collect()  # one state
        state = np.concatenate([np.frombuffer(g.numbers, np.float32) for g in sorted(got, key=lambda g: g.chunk)])
        shared.destroy()
    words.destroy()
    return {k: v.copy() for k, v in parts_of(state[:WEIGHTS]).items()}


def fit(docs: DataFrame, tokenizer: str = TOKENIZER) -> Model:
    """The model of all texts that aren't held out."""
    spark = docs.sparkSession
    ready(spark)
    with open(tokenizer, "rb") as f:
        proto = f.read()
    training = spell_texts(docs, spark.sparkContext.broadcast(proto))
    first, inner = piece_counts(training, tokenizer_of(proto).get_piece_size())
    vocabulary = Vocabulary(proto, first, inner)
    weights = trained(training, vocabulary, int(first.sum() + inner.sum()))
    model = Model(vocabulary, weights, topic_centres(training))
    discard(training)
    return model


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``block, doc_id, held, text``: rows dealt by a hash into blocks of about equal size."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(of=10).alias("held"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(total // block_bytes + 1)).cast("int").alias("block"), "doc_id", "held", "text")


def word_counts(dealt: DataFrame, centres: np.ndarray) -> DataFrame:
    """``block, word, lead, c0, c1, ...``: one row per block and word (the end among them): whether
    the row stands for the word, and the word's training counts over all blocks, by topic."""
    topics = len(centres)

    def run(table: pa.Table) -> pa.Table:
        w, h, _ = tokens_of(table.column("text").combine_chunks())
        learned = ~np.array(table.column("held").to_numpy(zero_copy_only=False), bool)
        topic = topic_of(byte_shapes(w.low, w.off), centres)
        word, number = np.unique(h, return_inverse=True)
        own = np.bincount(number * topics + topic[w.doc], learned[w.doc], len(word) * topics).reshape(-1, topics)
        own = np.concatenate([[np.bincount(topic, learned, topics)], own]).astype(np.int64)
        word = np.concatenate([[END_WORD], word])
        block = np.full(len(word), table.column("block")[0].as_py(), np.int32)
        return pa.table([pa.array(block), pa.array(word.view(np.int64)), *(pa.array(own[:, k]) for k in range(topics))], ["block", "word", *(f"own{k}" for k in range(topics))])

    rows = dealt.groupBy("block").applyInArrow(run, "block int, word long, " + ", ".join(f"own{k} long" for k in range(topics)))
    by_word = Window.partitionBy("word")
    lead = (F.row_number().over(by_word.orderBy("block")) == 1).alias("lead")
    return rows.select("block", "word", lead, *[F.sum(f"own{k}").over(by_word).alias(f"c{k}") for k in range(topics)])


def scored(docs: DataFrame, model: Model | None = None, tokenizer: str = TOKENIZER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row."""
    spark = docs.sparkSession
    ready(spark)
    model = model or fit(docs, tokenizer)
    topics = len(model.centres)
    dealt = blocks(docs, block_bytes)
    counts = store(word_counts(dealt, model.centres), "word-counts")
    columns = [F.col(f"c{k}") for k in range(topics)]
    groups = [*columns, sum(columns[1:], columns[0])]  # each topic, and all
    got = counts.where("lead").agg(*[F.sum(c) for c in groups], *[F.count_if(c > 0) for c in groups]).first()
    total = np.array([n or 0 for n in got[: topics + 1]], float)
    distinct = np.array(got[topics + 1 :], float)
    shared = spark.sparkContext.broadcast(model)  # the tokenizer file and about 100,000 numbers
    all_tokens = int(total[-1])
    floor = float(np.log10(total[-1] + 0.1 * (distinct[-1] + 1)))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        n = left.num_rows
        if not n:
            return pa.table([pa.array([], t) for t in kinds], names)
        w, h, (word, number) = tokens_of(left.column("text").combine_chunks())
        known = right.column("word").to_numpy().view(np.uint64)
        order = np.argsort(known)
        count = w.count + 1
        which = np.full(count.sum(), -1)
        inner = np.ones(len(which), bool)
        inner[np.cumsum(count) - 1] = False
        which[inner] = number
        there = np.searchsorted(known[order], np.concatenate([word, [END_WORD]]))  # every word of the block is there
        by_topic = [right.column(f"c{k}").to_numpy()[order][there].astype(float) for k in range(topics)]
        by_topic.append(sum(by_topic))
        seen = np.full(len(word), len(number))
        np.minimum.at(seen, number, np.arange(len(number)))
        ids, off = shared.value.vocabulary.encode(word_strings(w, seen)) if len(word) else (np.zeros(0, np.int32), np.zeros(1, np.int64))
        end_at = np.concatenate([[0], np.cumsum(count)])
        attention = np.zeros(len(which))
        at = 0
        while at < n:  # documents of about 50,000 tokens at a time, so that memory follows these
            to = max(at + 1, int(np.searchsorted(end_at, end_at[at] + 50_000, "right")) - 1)
            attention[end_at[at] : end_at[to]] = word_logs(shared.value, which[end_at[at] : end_at[to]], ids, off, count[at:to])
            at = to
        row = np.repeat(np.arange(n), count)
        everywhere = by_topic[-1][which]
        base = np.bincount(row, np.log10(everywhere + 0.1), n) - count * floor
        experts = [np.bincount(row, attention, n)]
        p = np.exp(np.maximum(attention, -600))
        for c, t, v in zip(by_topic, total, distinct, strict=True):
            if t:
                share = np.maximum(c - DISCOUNT, 0) / t
                experts.append(np.bincount(row, np.log(share[which] + DISCOUNT * v / t * p), n))
        e = np.stack(experts)
        top = e.max(0)
        score = (top + np.log(np.exp(e - top).mean(0))) / np.log(10)
        n_known = np.bincount(row, everywhere > 0, n).astype(np.int64)
        return pa.table([left.column("doc_id"), left.column("held"), pa.array(count), pa.array(n_known), pa.array(np.full(n, all_tokens)), pa.array(base), pa.array(score)], names)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    back = counts.select("block", "word", *columns)
    return dealt.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
