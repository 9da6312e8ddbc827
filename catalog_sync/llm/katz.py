"""Language-model scoring with Katz backoff.

N-gram counts are discounted by Good-Turing; the mass this frees goes to words
not seen after a context, in proportion to the next shorter context's model, by a
weight that makes each context's probabilities sum to one exactly. Tokens are
scored from the longest context to the shortest.

The corpus is cut into blocks of documents, dictionary-encoded once. For each
order a block asks, per bucket of contexts, for its distinct n-grams and tells
how often it has them in training documents; a bucket's task adds up, stores its part of
the model and answers each block in the block's own order. So an n-gram crosses the
network once per block as a small number, and no table has to fit into one task.

* A bucket holds whole contexts, but contexts with more than a bucket's fair share of the
  tokens (at most one per bucket, so a bounded number) are spread by their next
  word; their sums are added up in a small table that all tasks get.
* What a context's weight needs is additive (its count, how many of its n-grams were
  seen once, twice, ... and the shorter model's mass of its seen words), so the
  discounts, which need all buckets, are applied afterwards.
* Where no count of a context is discounted, its count is taken one larger, so that unseen words keep some mass.

Defined cases: null text is the end token alone; a null id stays null; repeated
rows are scored each; without training documents every token is unknown and has probability one;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_sync.llm.tables import Scratch

END = b""  # no word is empty
#: Counts above this are not discounted.
TOP = 5
BLOCK_TOKENS = 1 << 19
BUCKET_TOKENS = 1 << 21
MESSAGE = "kind string, bucket int, block_id long, a binary, b binary, c binary, d binary, e binary, f binary, g binary"
_FIELDS = [x.split()[0] for x in MESSAGE.split(", ")]


def squeeze(values: np.ndarray) -> bytes:
    """A numeric array as compressed bytes: smallest type, byte plane after byte plane."""
    a = np.ascontiguousarray(values)
    if a.dtype.kind in "iub":
        a = a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))  # values are not negative
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
    return a.dtype.char.encode() + len(a).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if len(a) else b"")


def unsqueeze(data: bytes) -> np.ndarray:
    kind, n = np.dtype(data[:1].decode()), int.from_bytes(data[1:9], "little")
    if not n:
        return np.empty(0, kind)
    planes = pa.decompress(data[9:], n * kind.itemsize, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel()


def tokens_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased words (runs without ASCII white space), then the end token."""
    return [*text.lower().split(), END]


def discounts(n_with: np.ndarray) -> np.ndarray:
    """Factor for each count 0..TOP+1 from how many n-grams occur 1..TOP+1 times.

    Good-Turing with Katz's correction, so that counts above the limit keep
    theirs; the limit is lowered until all factors lie between 0 and 1. Where the
    counts are too few for any limit, single occurrences are halved.
    """
    n = np.concatenate(([0.0], n_with.astype(float)))
    for top in range(TOP, 0, -1):
        if (n[1 : top + 2] > 0).all():
            r = np.arange(1, top + 1)
            tail = (top + 1) * n[top + 1] / n[1]
            d = ((r + 1) * n[r + 1] / n[r] / r - tail) / (1 - tail) if tail < 1 else np.zeros(top)
            if ((d > 0) & (d < 1)).all():
                return np.concatenate(([1.0], d, np.ones(TOP + 1 - top)))
    return np.concatenate(([1.0, 0.5], np.ones(TOP)))


def weights(stats: np.ndarray, lower: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Denominator and backoff weight of contexts. ``stats``: columns count, n-grams seen 1..TOP times; ``lower``: mass of the seen words in the shorter model."""
    freed = stats[:, 1:] @ ((1 - d[1 : TOP + 1]) * np.arange(1, TOP + 1))
    count = stats[:, 0].astype(float)
    base = np.where(freed > 0, count, count + 1)
    left = np.where(freed > 0, freed, 1.0) / np.maximum(base, 1)
    return base, left / np.maximum(1 - lower, 1e-300)


@dataclass
class Order:
    """What all tasks know of a finished order: its discounts and, for its spread contexts, their sums."""

    d: np.ndarray
    total: int  # n-grams in training
    kinds: int  # distinct ones
    freed: float  # mass that the discounts free
    hot: dict[int, tuple[np.ndarray, float]] = field(default_factory=dict)

    def unigram(self, count: np.ndarray) -> np.ndarray:
        """Probability of words by their training count; 0: all unknown words together."""
        base = max(self.total if self.freed > 0 else self.total + 1, 1)
        unknown = (self.freed if self.freed > 0 else 1.0) / base
        return np.where(count > 0, self.d[np.minimum(count, TOP + 1)] * count / base, unknown)


def _mix(a: np.ndarray, b: np.ndarray | int = 0) -> np.ndarray:
    h = (a.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ np.asarray(b).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return (h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(20)


def _message(kind: str, bucket: int, block_id: int, *parts: bytes) -> dict:
    return dict(zip(_FIELDS, (kind, bucket, block_id, *parts, *[b""] * (7 - len(parts))), strict=True))


def _table(messages: list[dict]) -> pa.Table:
    kinds = [pa.string(), pa.int32(), pa.int64(), *[pa.binary()] * 7]
    return pa.table({n: pa.array([m[n] for m in messages], k) for n, k in zip(_FIELDS, kinds, strict=True)})


def _add_bytes(parts: list[bytes]) -> bytes:
    return b"".join(len(x).to_bytes(8, "little") + x for x in parts)


def _split_bytes(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 8], "little")
        out.append(data[at + 8 : at + 8 + n])
        at += 8 + n
    return out


def encode_blocks(docs: DataFrame, folder: str, *, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Cut ``docs`` (``doc_id, held_out, text``) into blocks of whole documents, stored below ``folder``.

    A row per block: its documents' ids and where its words and its
    dictionary-encoded tokens lie. Later steps read them from there, so the
    tokens are never shuffled. Each task attempt writes a file of its own;
    only the rows of attempts that Spark commits name theirs.
    """
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([*[T.StructField(c, T.LongType()) for c in ("block_id", "n_tokens", "start", "middle", "stop")],
                           T.StructField("file", T.StringType()), T.StructField("doc_ids", T.ArrayType(id_type))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        seen: dict[bytes, int] = {}
        ids, held, lengths, tokens, n_blocks, total, kind = [], [], [], [], 0, 0, None
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name, sink = f"{uuid.uuid4().hex}.blocks", None

        def block() -> pa.RecordBatch:
            local = np.concatenate(tokens)
            order = np.argsort(-np.bincount(local, minlength=len(seen)), kind="stable")  # frequent words get small numbers
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            listed = list(seen)
            words = pa.compress(b"\n".join(listed[i] for i in order), "zstd", asbytes=True)
            words = _add_bytes([sum(len(w) + 1 for w in listed).to_bytes(8, "little"), words])
            body = _add_bytes([squeeze(np.array(held)), squeeze(np.array(lengths)), squeeze(place[local])])
            start = sink.tell()
            sink.write(words + body)
            places = [start, start + len(words), start + len(words) + len(body)]
            row = [pa.array([x], pa.int64()) for x in ((TaskContext.get().partitionId() << 32) + n_blocks, len(local), *places)]
            return pa.RecordBatch.from_arrays([*row, pa.array([name]), pa.array([ids], pa.list_(kind))], names=schema.names)

        for batch in batches:
            kind = batch.column(0).type
            texts = batch.column(2).cast(pa.large_binary() if pa.types.is_large_string(batch.column(2).type) else pa.binary())
            for doc_id, out, text in zip(batch.column(0), batch.column(1).to_pylist(), texts, strict=True):
                sink = sink or store.open_output_stream(f"{base}/{name}", compression=None)
                own = tokens_of(text.as_py() or b"")
                tokens.append(np.array([seen.setdefault(w, len(seen)) for w in own], np.int64))
                ids.append(doc_id.as_py())
                held.append(bool(out))
                lengths.append(len(own))
                total += len(own)
                if total >= block_tokens:
                    yield block()
                    seen, ids, held, lengths, tokens, n_blocks, total = {}, [], [], [], [], n_blocks + 1, 0
        if ids:
            yield block()
        if sink:
            sink.close()

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, schema)


def _read(folder: str, row: pa.Table, words: bool) -> list[bytes]:
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    start, middle, stop = (row[c][0].as_py() for c in ("start", "middle", "stop"))
    a, b = (start, middle) if words else (middle, stop)
    with store.open_input_file(f"{base}/{row['file'][0].as_py()}") as f:
        f.seek(a)
        return _split_bytes(f.read(b - a))


def word_requests(folder: str, row: pa.Table, n_buckets: int) -> list[dict]:
    """A block's distinct words with their training counts, per bucket of words."""
    size, packed = _read(folder, row, True)
    words = pa.decompress(packed, int.from_bytes(size, "little") - 1, "zstd", asbytes=True).split(b"\n")
    b = Block(folder, row, None, [], n_buckets)
    counts = np.bincount(b.tokens[b.train], minlength=len(words))
    bucket = np.array([zlib.crc32(w) % n_buckets for w in words], np.int64)
    out = []
    for k in np.unique(bucket):
        at = np.flatnonzero(bucket == k)
        listed = b"\n".join(words[i] for i in at)
        out.append(_message("words", int(k), b.id, pa.compress(listed, "zstd", asbytes=True), squeeze(np.array([len(listed)])), squeeze(counts[at]), squeeze(np.diff(at, prepend=0))))
    return out


class Block:
    """One decoded block, and its tokens' probabilities as far as the orders in ``replies`` go."""

    def __init__(self, folder: str, row: pa.Table, replies: pa.Table | None, orders: list[Order], n_buckets: int):
        self.hot_count = orders[0].total / n_buckets if orders else 0.0
        self.id, self.n_buckets, self.orders = row["block_id"][0].as_py(), n_buckets, orders
        held, lengths, tokens = (unsqueeze(x) for x in _read(folder, row, False))
        self.held, self.lengths, self.tokens = held.astype(bool), lengths.astype(np.int64), tokens.astype(np.int64)
        self.train = ~np.repeat(self.held, self.lengths)
        self.first = np.cumsum(self.lengths) - self.lengths
        answers: dict[str, dict[int, list[np.ndarray]]] = {}
        if replies is not None:
            for m in replies.to_pylist():
                answers.setdefault(m["kind"], {})[m["bucket"]] = [unsqueeze(m[c]) if m[c] else np.empty(0) for c in "abcdefg"]
        if orders:
            self._words(answers["reply1"])
            for n in range(2, len(orders) + 1):
                self._order(n, answers.get(f"reply{n}", {}))

    def _words(self, answer: dict[int, list[np.ndarray]]) -> None:
        n_words = int(self.tokens.max()) + 1
        self.word_id, self.word_count = np.empty(n_words, np.int64), np.empty(n_words, np.int64)
        for ids, counts, steps, *_ in answer.values():
            at = np.cumsum(steps.astype(np.int64))
            self.word_id[at], self.word_count[at] = ids.astype(np.int64) - 1, counts
        self.p = self.orders[0].unigram(self.word_count)[self.tokens]
        self.gram, self.gram_count = self.word_id[self.tokens], self.word_count[self.tokens]

    def _layout(self) -> None:
        """Contexts (known n-grams before a token) and distinct pairs of context and known word, with their buckets."""
        context, count = np.roll(self.gram, 1), np.roll(self.gram_count, 1)
        context[self.first] = -1
        self.at = np.flatnonzero(context >= 0)  # positions with a context
        self.contexts, self.context_of = np.unique(context[self.at], return_inverse=True)
        counts = np.zeros(len(self.contexts), np.int64)
        counts[self.context_of] = count[self.at]
        self.is_hot = counts >= self.hot_count
        known = self.word_id[self.tokens[self.at]] >= 0
        self.paired = np.flatnonzero(known)  # places in self.at
        keys, self.pair_of = np.unique(self.context_of[self.paired] * len(self.word_id) + self.tokens[self.at[self.paired]], return_inverse=True)
        self.pair_context, self.pair_word = keys // len(self.word_id), keys % len(self.word_id)
        ids, words = self.contexts[self.pair_context], self.word_id[self.pair_word]
        bucket = np.where(self.is_hot[self.pair_context], _mix(ids, words), _mix(ids)) % np.uint64(self.n_buckets)
        self.pair_order = np.lexsort((self.pair_context, bucket))
        self.pair_ends = np.searchsorted(bucket[self.pair_order], np.arange(self.n_buckets + 1))
        own = (_mix(self.contexts) % np.uint64(self.n_buckets)).astype(np.int64)
        self.context_order = np.argsort(own, kind="stable")
        self.context_ends = np.searchsorted(own[self.context_order], np.arange(self.n_buckets + 1))

    def _asked(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Contexts and pairs that the block asks bucket ``b`` for, the pairs by context."""
        pairs = self.pair_order[self.pair_ends[b] : self.pair_ends[b + 1]]
        own = self.context_order[self.context_ends[b] : self.context_ends[b + 1]]
        return np.union1d(self.pair_context[pairs], own[~self.is_hot[own]]), pairs

    def requests(self, n: int) -> list[dict]:
        self._layout()
        train = np.bincount(self.pair_of, weights=self.train[self.at[self.paired]], minlength=len(self.pair_word)).astype(np.int64)
        lower = np.zeros(len(self.pair_word))
        lower[self.pair_of] = self.p[self.at[self.paired]]
        lower[train == 0] = 0  # only n-grams of training documents count
        if n == 2:  # the shorter model's probability follows from the word's count, which is a smaller number
            values, code = np.empty(0), np.where(train > 0, self.word_count[self.pair_word], 0)
        else:
            values, code = np.unique(lower, return_inverse=True)
        before_unknown = np.zeros(len(self.contexts), bool)
        before_unknown[np.delete(self.context_of, self.paired)] = True
        out = []
        for b in range(self.n_buckets):
            contexts, pairs = self._asked(b)
            if len(contexts):
                width = np.bincount(np.searchsorted(contexts, self.pair_context[pairs]), minlength=len(contexts))
                used, small = np.unique(code[pairs], return_inverse=True) if n > 2 else ([], code[pairs])
                out.append(_message(f"grams{n}", b, self.id, squeeze(self.contexts[contexts]), squeeze(width), squeeze(self.word_id[self.pair_word[pairs]]),
                                    squeeze(train[pairs]), squeeze(small), squeeze(values[used] if n > 2 else values), squeeze(2 * self.is_hot[contexts] + before_unknown[contexts])))
        return out

    def _order(self, n: int, answer: dict[int, list[np.ndarray]]) -> None:
        self._layout()
        order = self.orders[n - 1]
        count, gram = np.zeros(len(self.pair_word), np.int64), np.full(len(self.pair_word), -1, np.int64)
        # of contexts after which the block has an unseen word all sums are told, of others the count and the smallest count after them
        stats, lower = np.zeros((len(self.contexts), TOP + 1)), np.zeros(len(self.contexts))
        for b in range(self.n_buckets):
            contexts, pairs = self._asked(b)
            if len(contexts):
                got, ids, totals, least, whole, sums, mass = answer[b]
                count[pairs] = got
                if len(ids):
                    gram[pairs] = ids.astype(np.int64) - 1
                stats[contexts, 0] = totals
                stats[contexts, least.astype(np.int64)] += (least > 0)
                at = contexts[whole.astype(np.int64)]
                stats[at, 1:], lower[at] = sums.reshape(-1, TOP), mass
        for i in np.flatnonzero(self.is_hot):
            stats[i], lower[i] = order.hot[int(self.contexts[i])]
        base, weight = weights(stats, lower, order.d)
        p = self.p.copy()
        p[self.at] *= weight[self.context_of]
        seen = count[self.pair_of] > 0
        where, c = self.paired[seen], count[self.pair_of][seen]
        p[self.at[where]] = order.d[np.minimum(c, TOP + 1)] * c / base[self.context_of[where]]
        self.p = p
        grams, counts = np.full(len(p), -1, np.int64), np.zeros(len(p), np.int64)
        grams[self.at[self.paired]], counts[self.at[self.paired]] = gram[self.pair_of], count[self.pair_of]
        self.gram, self.gram_count = grams, counts


def _add_words(n_buckets: int):
    def run(table: pa.Table) -> pa.Table:
        bucket, asked = table["bucket"][0].as_py(), []
        total: dict[bytes, int] = {}
        for m in table.to_pylist():
            words = pa.decompress(m["a"], int(unsqueeze(m["b"])[0]), "zstd", asbytes=True).split(b"\n")
            asked.append((m["block_id"], words, m["d"]))
            for w, c in zip(words, unsqueeze(m["c"]).tolist(), strict=True):
                total[w] = total.get(w, 0) + c
        model = sorted(((-c, w) for w, c in total.items() if c))
        number = {w: k * n_buckets + bucket + 1 for k, (_, w) in enumerate(model)}
        counts = np.array([-c for c, _ in model], np.int64)
        out = [_message("reply1", bucket, block_id, squeeze(np.array([number.get(w, 0) for w in words], np.int64)), squeeze(np.array([total[w] for w in words], np.int64)), steps)
               for block_id, words, steps in asked]
        out.append(_message("stats1", bucket, -1, squeeze(np.concatenate((np.bincount(counts[counts <= TOP + 1], minlength=TOP + 2)[1:], [counts.sum(), len(counts)])).astype(np.int64))))
        out.append(_message("model1", bucket, -1, b"\n".join(w for _, w in model), squeeze(counts)))
        return _table(out)

    return run


def _add_grams(n: int, n_buckets: int, last: bool, words: Order):
    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        asked, parts, hot = [], [], []
        for m in table.sort_by("block_id").to_pylist():
            context, width, word, train, code, values, marks = (unsqueeze(m[c]) for c in "abcdefg")
            context = context.astype(np.int64)
            asked.append((m["block_id"], len(word), context, width.astype(np.int64), marks % 2 == 1))
            hot.append(context[marks >= 2])
            parts.append((np.repeat(context, width.astype(np.int64)), word.astype(np.int64), train.astype(np.int64), np.where(code > 0, words.unigram(code.astype(np.int64)), 0) if n == 2 else values[code] if len(code) else np.empty(0)))
        context, word, train, lower = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((word, context))
        sorted_context, sorted_word = context[order], word[order]
        new = np.ones(len(order), bool)
        new[1:] = (sorted_context[1:] != sorted_context[:-1]) | (sorted_word[1:] != sorted_word[:-1])
        starts = np.flatnonzero(new)
        total = np.add.reduceat(train[order], starts) if len(starts) else np.empty(0, np.int64)
        gram_of = np.empty(len(order), np.int64)
        gram_of[order] = np.cumsum(new) - 1
        gram_context, gram_word, gram_lower = sorted_context[starts], sorted_word[starts], np.maximum.reduceat(lower[order], starts) if len(starts) else lower
        seen = total > 0
        number = np.where(seen, (np.cumsum(seen) - 1) * n_buckets + bucket + 1, 0)
        contexts = np.unique(np.concatenate([x[2] for x in asked]))
        place = np.searchsorted(contexts, gram_context)
        stats = np.empty((len(contexts), TOP + 1), np.int64)
        stats[:, 0] = np.bincount(place, weights=total, minlength=len(contexts))
        for r in range(1, TOP + 1):
            stats[:, r] = np.bincount(place[total == r], minlength=len(contexts))
        mass = np.bincount(place[seen], weights=gram_lower[seen], minlength=len(contexts))
        out, at = [], 0
        least = np.where((stats[:, 1:] > 0).any(axis=1), (stats[:, 1:] > 0).argmax(axis=1) + 1, 0)
        for block_id, size, own, width, before_unknown in asked:
            mine, rows = gram_of[at : at + size], np.searchsorted(contexts, own)
            unseen = np.bincount(np.repeat(np.arange(len(own)), width), weights=total[mine] == 0, minlength=len(own)) > 0
            whole = np.flatnonzero(unseen | before_unknown)
            out.append(_message(f"reply{n}", bucket, block_id, squeeze(total[mine]), b"" if last else squeeze(number[mine]), squeeze(stats[rows, 0]), squeeze(least[rows]),
                                squeeze(whole), squeeze(stats[rows[whole], 1:].ravel()), squeeze(mass[rows[whole]])))
            at += size
        few = total[seen & (total <= TOP + 1)]
        out.append(_message(f"stats{n}", bucket, -1, squeeze(np.concatenate((np.bincount(few, minlength=TOP + 2)[1:], [total.sum(), seen.sum()])).astype(np.int64))))
        spread = np.searchsorted(contexts, np.unique(np.concatenate(hot)))
        if len(spread):
            out.append(_message(f"sums{n}", bucket, -1, squeeze(contexts[spread]), squeeze(stats[spread].ravel()), squeeze(mass[spread])))
        out.append(_message(f"model{n}", bucket, -1, squeeze(contexts), squeeze(np.bincount(place[seen], minlength=len(contexts))), squeeze(gram_word[seen]), squeeze(total[seen])))
        return _table(out)

    return run


def _ask_grams(folder: str, n: int, orders: list[Order], n_buckets: int):
    def run(row: pa.Table, answers: pa.Table) -> pa.Table:
        return _table(Block(folder, row, answers, orders, n_buckets).requests(n) if len(row) else [])

    return run


def _finish(counted: DataFrame, n: int) -> Order:
    """The order's discounts from its buckets' statistics, and the sums of its spread contexts (at most one per bucket)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [unsqueeze(x.as_py()).astype(np.int64) for x in batch.column(0)]
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.stack(got).T], names=[f"n{i}" for i in range(TOP + 3)])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, c in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                stats = unsqueeze(b).astype(np.int64).reshape(-1, TOP + 1)
                yield pa.RecordBatch.from_arrays([pa.array(unsqueeze(a).astype(np.int64)), *[pa.array(x) for x in stats.T], pa.array(unsqueeze(c).astype(float))],
                                                 names=["context", *[f"s{i}" for i in range(TOP + 1)], "mass"])

    of_kind = lambda k, *c: counted.filter(F.col("kind") == f"{k}{n}").select(*c)
    numbers = of_kind("stats", "a").mapInArrow(rows, ", ".join(f"n{i} long" for i in range(TOP + 3))).groupBy().sum().first()
    numbers = np.array([x or 0 for x in numbers], np.int64)
    d = discounts(numbers[: TOP + 1])
    freed = float(((1 - d[1 : TOP + 1]) * np.arange(1, TOP + 1) * numbers[:TOP]).sum())
    order = Order(d, int(numbers[TOP + 1]), int(numbers[TOP + 2]), freed)
    if n > 1:
        names = [f"s{i}" for i in range(TOP + 1)]
        spread = of_kind("sums", "a", "b", "c").mapInArrow(sums, "context long, " + ", ".join(f"{x} long" for x in names) + ", mass double")
        for r in spread.groupBy("context").agg(*[F.sum(x).alias(x) for x in names], F.sum("mass").alias("mass")).collect():
            order.hot[r["context"]] = (np.array([r[x] for x in names], float), r["mass"])
    return order


def score(docs: DataFrame, scratch: Scratch, *, order: int = 2, n_buckets: int | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Score every document of ``docs`` (``doc_id, held_out, text``) by the model of those not held out.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``:
    ``score`` is the log10 probability of the text, ``base_score`` that of
    add-one unigrams. The model lies in the tables ``order-N`` of the
    scratch folder, partitioned by kind, a row per bucket.
    """
    spark = docs.sparkSession
    folder = scratch.place("block-files")
    blocks = scratch.write(encode_blocks(docs, folder, block_tokens=block_tokens), "blocks")
    if n_buckets is None:
        total = blocks.agg(F.sum("n_tokens")).first()[0] or 0
        n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_TOKENS))
    buckets, orders, replies = n_buckets, [], None

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _table(word_requests(folder, pa.Table.from_batches([batch.slice(i, 1)]), buckets)).to_batches()

    for n in range(1, order + 1):
        if n == 1:
            counted = blocks.mapInArrow(ask_words, MESSAGE).groupBy("bucket").applyInArrow(_add_words(buckets), MESSAGE)
        else:
            asked = blocks.groupBy("block_id").cogroup(replies.groupBy("block_id")).applyInArrow(_ask_grams(folder, n, list(orders), buckets), MESSAGE)
            counted = asked.groupBy("bucket").applyInArrow(_add_grams(n, buckets, n == order, orders[0]), MESSAGE)
        where = scratch.place(f"order-{n}")
        counted.write.partitionBy("kind").parquet(where)
        counted = spark.read.schema(MESSAGE).parquet(where).select(*_FIELDS)
        orders.append(_finish(counted, n))
        own = counted.filter(F.col("kind") == f"reply{n}")
        replies = own if replies is None else replies.union(own)

    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("held_out", T.BooleanType()),
                           *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")],
                           *[T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]])
    train, kinds = orders[0].total, orders[0].kinds

    def judge(row: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(row):
            return schema_table.slice(0, 0)
        b = Block(folder, row, answers, orders, buckets)
        add = lambda x: np.add.reduceat(x, b.first)  # noqa: E731  every document has a token
        counts = b.word_count[b.tokens]
        ids = row["doc_ids"].combine_chunks().flatten()
        return pa.table({"doc_id": ids, "held_out": pa.array(b.held), "n_tokens": pa.array(b.lengths), "n_known": pa.array(add((counts > 0).astype(np.int64))),
                         "train_tokens": pa.array(np.full(len(b.held), train)), "base_score": pa.array(add(np.log10((counts + 1) / (train + kinds + 1)))),
                         "score": pa.array(add(np.log10(b.p)))})

    from pyspark.sql.pandas.types import to_arrow_schema

    schema_table = to_arrow_schema(schema).empty_table()
    return blocks.groupBy("block_id").cogroup(replies.groupBy("block_id")).applyInArrow(judge, schema)
