"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut into words (a run of the space mark with what follows it); no
piece of the vocabulary crosses such a border, so words merge independently.
The distinct new words of a batch become one flat array of symbols.  Each
round finds the smallest pair rank of every word (a segmented minimum), merges
its leftmost non-overlapping occurrences in all words at once and compacts the
array, until no pair remains.  Where a merged piece could take part in a pair
of better or equal rank, or where ranks tie, only the leftmost occurrence
merges in that round, as the sequential algorithm would.

Encoding starts with the dummy space mark, keeps all white space, has no
sampling, and spells unknown characters by byte pieces; the model must be a
BPE model with the identity normaliser and byte fallback.

Cases: a null or empty text has no pieces (begin and end ids only, if asked
for) and decodes to the empty text; any length works, words being cached up to
a fixed number a worker; ids outside the vocabulary raise an error when
decoded; repeated rows are encoded alike; a table without rows gives none; a
column with the name of a result column is replaced.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bytes_list, record_batch, sha256_hex, text_slices

MARK = "▁"
_FAR = np.iinfo(np.int64).max


class Vocabulary:
    """Pieces, pair ranks and byte pieces of a model file."""

    def __init__(self, model: bytes):
        import sentencepiece
        p = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = p.get_piece_size()
        self.pieces = [p.id_to_piece(i) for i in range(n)]
        self.bos, self.eos, self.unk = p.bos_id(), p.eos_id(), p.unk_id()
        special = np.array([p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i) for i in range(n)])
        self.byte_ids = np.array([p.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int64)
        self.normal = {piece: i for i, piece in enumerate(self.pieces) if not special[i]}
        # Ranks by descending score; equal scores share a rank.
        scores = np.array([p.get_score(i) for i in range(n)])
        _, rank = np.unique(-scores, return_inverse=True)
        self.is_byte = np.array([p.is_byte(i) for i in range(n)])
        self.is_control = np.array([p.is_control(i) for i in range(n)])
        self.unknown_text = " ⁇ "

        # Symbols: every string that merging can reach; a single character that
        # is no piece itself still takes part in merges.
        symbols = dict(self.normal)
        chars = {c for piece in self.normal for c in piece}
        for c in sorted(chars):
            symbols.setdefault(c, n + len(symbols))
        self.symbols = {s: i for i, s in enumerate(symbols)}
        self.symbol_id = np.array([self.normal.get(s, -1) for s in self.symbols], dtype=np.int64)
        self.chars = {c: self.symbols[c] for c in chars}
        left, right, made, ranks = [], [], [], []
        for piece, i in self.normal.items():
            for k in range(1, len(piece)):
                a, b = self.symbols.get(piece[:k]), self.symbols.get(piece[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(self.symbols[piece])
                    ranks.append(rank[i])
        left, right, made, ranks = (np.array(x, dtype=np.int64) for x in (left, right, made, ranks))
        order = np.argsort(left * len(self.symbols) + right)
        self.pair = (left * len(self.symbols) + right)[order]
        self.made, self.rank = made[order], ranks[order]
        # A piece is eager if a pair with it may merge before, or tie with, its own rank.
        best = np.full(len(self.symbols), _FAR)
        np.minimum.at(best, left, ranks)
        np.minimum.at(best, right, ranks)
        own = np.full(len(self.symbols), _FAR)
        own[made] = ranks
        tied = np.bincount(rank, minlength=rank.max() + 1) > 1
        self.eager = (best <= own) | np.append(tied, False)[np.where(own == _FAR, -1, own)]
        # Words: no piece has the mark behind another character, nor any
        # character that only stands alone.
        if any(MARK in piece.lstrip(MARK) for piece in self.normal):
            raise ValueError("the vocabulary has pieces that cross word borders")
        joined = {c for piece in self.normal if len(piece) > 1 for c in piece}
        self.alone = "\n" not in joined
        gap = "\n" if self.alone else ""
        self.split = re.compile(f"{MARK}+[^{MARK}{gap}]*|[^{MARK}{gap}]+" + ("|\n" if gap else ""))
        self.words: dict[str, bytes] = {}
        # Long runs of marks: full pieces from the left, if the model does so.
        self.longest = max(len(piece) for piece in self.normal if not piece.strip(MARK))
        full = np.array([self.normal[MARK * self.longest]], dtype="<u4").tobytes()
        self.full_run = full if self.merge_words([MARK * self.longest * 3])[0] == full * 3 else None

    # -- encoding -------------------------------------------------------------

    def merge_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        size = len(self.symbols)
        chars = self.chars
        lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        text = "".join(words)
        # An unknown character gets a negative symbol: minus its place, minus 1.
        sym = np.fromiter((chars.get(c, -1 - k) for k, c in enumerate(text)), dtype=np.int64, count=len(text))
        word = np.repeat(np.arange(len(words)), lens)
        live_sym, live_word, done_sym, done_word = sym, word, [], []
        while True:
            if len(live_sym) > 1:
                a, b = live_sym[:-1], live_sym[1:]
                key = np.where((live_word[:-1] == live_word[1:]) & (a >= 0) & (b >= 0), a * size + b, -1)
                at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
                known = self.pair[at] == key
                rank = np.where(known, self.rank[at], _FAR)
                made = self.made[at]
            else:
                rank, made = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            rank = np.append(rank, _FAR)  # a pair for every left place
            made = np.append(made, 0)
            first = np.flatnonzero(np.append(True, live_word[1:] != live_word[:-1])) if len(live_word) else live_word
            low = np.minimum.reduceat(rank, first) if len(first) else rank[:0]
            counts = np.diff(np.append(first, len(live_word)))
            active = np.repeat(low < _FAR, counts)
            if not active.all():  # words without a pair are done
                done_sym.append(live_sym[~active])
                done_word.append(live_word[~active])
                keep = np.flatnonzero(active)
                live_sym, live_word, rank, made = live_sym[keep], live_word[keep], rank[keep], made[keep]
                counts, low = counts[low < _FAR], low[low < _FAR]
            if not len(live_sym):
                break
            hit = rank == np.repeat(low, counts)
            start = np.cumsum(counts) - counts
            # Leftmost non-overlapping: every second one of a run of adjacent hits.
            place = np.arange(len(hit))
            run_start = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), place, -1))
            take = hit & ((place - run_start) % 2 == 0)
            order_first = np.minimum.reduceat(np.where(hit, place, len(hit)), start)
            careful = np.zeros(len(counts), dtype=bool)
            chosen = np.flatnonzero(take)
            owner = np.repeat(np.arange(len(counts)), counts)
            careful[owner[chosen[self.eager[made[chosen]]]]] = True
            take &= ~careful[owner] | (place == order_first[owner])
            live_sym = np.where(take, made, live_sym)
            stay = ~np.append(False, take[:-1])
            live_sym, live_word = live_sym[stay], live_word[stay]
        sym = np.concatenate(done_sym) if done_sym else sym
        word = np.concatenate(done_word) if done_word else word
        order = np.argsort(word, kind="stable")
        sym, word = sym[order], word[order]
        return self._ids(sym, word, len(words), text)

    def _ids(self, sym: np.ndarray, word: np.ndarray, n_words: int, text: str) -> list[bytes]:
        ids = np.where(sym >= 0, self.symbol_id[np.maximum(sym, 0)], -1)
        if (ids < 0).any():  # spell by byte pieces
            names = list(self.symbols)
            parts, owners = [], []
            for s, i, w in zip(sym.tolist(), ids.tolist(), word.tolist(), strict=True):
                spelt = [i] if i >= 0 else self.byte_ids[
                    np.frombuffer((names[s] if s >= 0 else text[-1 - s]).encode(), np.uint8)].tolist()
                parts += spelt
                owners += [w] * len(spelt)
            ids, word = np.array(parts, dtype=np.int64), np.array(owners, dtype=np.int64)
        flat = ids.astype("<u4").tobytes()
        ends = (np.cumsum(np.bincount(word, minlength=n_words)) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if n_words else []

    def encode_batch(self, texts: list[str | None], cache_words: int = 200_000) -> list[bytes]:
        """Ids of each text, without begin and end ids."""
        find = self.split.findall
        cut = [find(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.words) > cache_words:
            self.words.clear()
        new = list({w for words in cut for w in words if w not in self.words})
        for k in range(0, len(new), 50_000):
            part = new[k: k + 50_000]
            self.words.update(zip(part, self._merge_runs(part), strict=True))
        get = self.words.__getitem__
        return [b"".join(map(get, words)) for words in cut]

    def _merge_runs(self, words: list[str]) -> list[bytes]:
        """``merge_words``, with the full pieces at the left of very long runs
        of marks written down at once: they merge last, from the left."""
        spare = [0] * len(words)
        if self.full_run is not None:
            for k, w in enumerate(words):
                run = len(w) - len(w.lstrip(MARK))
                if run >= 4 * self.longest:
                    spare[k] = run // self.longest - 2
        short = [w[n * self.longest:] if n else w for w, n in zip(words, spare, strict=True)]
        return [self.full_run * n + x if n else x for n, x in zip(spare, self.merge_words(short), strict=True)]

    # -- decoding -------------------------------------------------------------

    def spelling(self) -> list[bytes]:
        """What each id stands for; byte pieces stand for their byte."""
        if not hasattr(self, "_spelling"):
            byte = {int(i): bytes([b]) for b, i in enumerate(self.byte_ids)}
            self._spelling = [byte.get(i) or (b"" if self.is_control[i] else self.unknown_text.encode()
                                              if i == self.unk else p.replace(MARK, " ").encode())
                              for i, p in enumerate(self.pieces)]
        return self._spelling

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of the ids: the dummy space at the front goes, control
        ids are silent, bytes that are not UTF-8 become U+FFFD each."""
        spelling = self.spelling()
        places = ids.tolist()
        first = next((i for i in places if not self.is_control[i]), None)
        out = b"".join(map(spelling.__getitem__, places))
        if self.is_byte[ids].any():
            out = self._repaired(ids, out)
        if first is not None and self.pieces[first].startswith(MARK):
            out = out[1:]
        return out

    def _repaired(self, ids: np.ndarray, joined: bytes) -> bytes:
        """``joined``, or a version in which every stray byte is U+FFFD: runs of
        byte pieces are read by themselves, as no other piece continues them."""
        spelling, flags = self.spelling(), self.is_byte[ids]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
        out, last, same = [], 0, True
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            raw = b"".join(spelling[i] for i in ids[a:b].tolist())
            try:
                raw.decode()
                fixed = raw
            except UnicodeDecodeError:
                fixed, same = _replace_stray(raw), False
            out += [b"".join(spelling[i] for i in ids[last:a].tolist()), fixed]
            last = b
        if same:
            return joined
        return b"".join([*out, *(spelling[i] for i in ids[last:].tolist())])


def _replace_stray(raw: bytes) -> bytes:
    out, k = [], 0
    while k < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[k: k + size].decode().encode())
                k += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�".encode())
            k += 1
    return b"".join(out)


def _vocabulary(model) -> Vocabulary:
    """The worker's vocabulary: built once a process for a broadcast model."""
    key = sha256_hex(model.value)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Vocabulary(model.value)
    return _BUILT[key]


_BUILT: dict[str, Vocabulary] = {}


def read_model(path: str) -> bytes:
    """The model file's bytes, read on the driver (well under 1 MB) and sent to
    the tasks, which need not see the path."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model_path: str, text: str = "text", begin: bool = True, end: bool = True,
           keep_text: bool = True, digests: bool = False) -> DataFrame:
    """The documents with ``ids`` (array of integers) and ``decoded`` (the text
    of the ids).  With ``digests`` there are ``n_tokens``, ``ids_sha256`` and
    ``decoded_sha256`` in their place."""
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    made = ([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
             T.StructField("decoded_sha256", T.StringType())] if digests else
            [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    docs = docs.drop(*(f.name for f in made if f.name != text))
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    schema = T.StructType(kept + made)

    def run(batches):
        vocab = _vocabulary(model)
        head = np.array([vocab.bos] if begin else [], dtype="<u4").tobytes()
        tail = np.array([vocab.eos] if end else [], dtype="<u4").tobytes()
        for batch in batches:
            for part in text_slices(batch, text):
                texts = [None if t is None else t.decode() for t in bytes_list(part.column(text))]
                ids = [head + x + tail for x in vocab.encode_batch(texts)]
                arrays = [np.frombuffer(x, dtype="<u4") for x in ids]
                plain = [vocab.decode(x) for x in arrays]
                if digests:
                    new = [[len(x) for x in arrays], [sha256_hex(x) for x in ids], [sha256_hex(x) for x in plain]]
                else:
                    new = [[x.astype(np.int32) for x in arrays], [x.decode() for x in plain]]
                yield record_batch(schema, [part.column(f.name) for f in kept] + new)

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with the text of an id column (null ids: empty text)."""
    model = rows.sparkSession.sparkContext.broadcast(read_model(model_path))

    @F.pandas_udf("string")
    def text_of(column):
        vocab = _vocabulary(model)
        return column.map(lambda x: "" if x is None else vocab.decode(np.asarray(x, dtype=np.int64)).decode())

    return rows.withColumn(out, text_of(F.coalesce(F.col(ids), F.array().cast("array<int>"))))
