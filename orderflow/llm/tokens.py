"""Token-id output as wavelet-matrix shards.

Documents are put in ascending id order by a range partitioning, encoded with
the given tokenizer, and written as shard files.  A shard file holds its
tokens once, as the bit planes of a wavelet matrix, and a bit vector of the
documents' last tokens.  All of them are cut into blocks of ``BLOCK_BYTES``, each a
Zstandard frame, and the header tells the frames and the ones before every
block (the rank directory).  So a shard gives random token access, counts and the places of a token
(``rank``, ``select``) from the blocks they touch, without inflating the rest,
and decodes as a whole.  Reading back takes where documents start and end
from the bit vector, and how often a token stands in each document from the ranks of
its bounds.

Shards are named by partition, attempt and number and moved into place when
complete.  A manifest table lists those of the tasks that succeeded; the
position of a shard among all tokens is the sum of the shards before it.

Words between blanks are encoded once per task process and remembered: the
tokenizer drops white space and never joins across it, so the ids of a text
are those of its words (any other tokenizer file is given whole texts).

Defined results: a null or empty text has only the end id; a null id sorts
first; rows that repeat an id are kept, ordered by text (nulls first); an
empty table gives no shard; further columns are not read.
"""

from __future__ import annotations

import json
import os
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.base import claim, read_file, record_batch, task_name, write_file, write_scratch
from orderflow.session import scratch_dir

SHARD_TOKENS = 1 << 20
GROUP_BYTES = 4 << 20
MAGIC = b"WVMX0002"
BLOCK_BYTES = 32 << 10           # of a bit vector, inflated at a time
MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long, n_bytes long"


# -- wavelet matrix ----------------------------------------------------------

class BitVector:
    """Bits in blocks that are inflated when they are touched; ``before`` holds
    the ones before each block."""

    def __init__(self, n: int, before: np.ndarray, load):
        self.n, self.before, self._load = n, before, load
        self._blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @classmethod
    def of(cls, packed: np.ndarray, n: int) -> BitVector:
        parts = [packed[i:i + BLOCK_BYTES] for i in range(0, len(packed), BLOCK_BYTES)]
        ones = [int(np.bitwise_count(p).sum(dtype=np.int64)) for p in parts]
        return cls(n, np.append(0, np.cumsum(ones, dtype=np.int64)), parts.__getitem__)

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """A block's bytes and the ones before each of them."""
        if k not in self._blocks:
            data = self._load(k)
            self._blocks[k] = data, np.append(0, np.cumsum(np.bitwise_count(data), dtype=np.int64))
        return self._blocks[k]

    def packed(self) -> np.ndarray:
        parts = [self._load(k) for k in range(len(self.before) - 1)]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint8)

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.packed(), count=self.n).view(bool)

    def get(self, i: int) -> int:
        byte = i >> 3
        return int(self.block(byte // BLOCK_BYTES)[0][byte % BLOCK_BYTES]) >> (7 - (i & 7)) & 1

    def ranks(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits, for many ``i``."""
        out = np.empty(len(i), np.int64)
        byte = i >> 3
        which = byte // BLOCK_BYTES
        for k in np.unique(which).tolist():
            mine = np.flatnonzero(which == k)
            out[mine] = self.before[min(k, len(self.before) - 1)]
            if k < len(self.before) - 1:
                data, ones = self.block(k)
                at = byte[mine] - k * BLOCK_BYTES
                part = np.append(data, np.uint8(0))[at] >> (8 - (i[mine] & 7)).astype(np.uint8)
                out[mine] += ones[at] + np.where(i[mine] & 7, np.bitwise_count(part), 0)
        return out

    def rank(self, i: int) -> int:
        return int(self.ranks(np.array([i]))[0])

    def select(self, k: int, bit: int = 1) -> int:
        """Position of the ``k``-th bit (from 0) of this value."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self.rank(mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                hi = mid
            else:
                lo = mid + 1
        return lo


class WaveletMatrix:
    """Bit planes from the highest bit down; each level holds the zeros of
    the level above first, then its ones, in stable order."""

    def __init__(self, planes: list[BitVector], zeros: list[int], n: int):
        self.planes, self.zeros, self.n = planes, zeros, n

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros = [], []
        cur = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        for level in reversed(range(bits)):
            bit = (cur & cur.dtype.type(1 << level)).astype(bool)
            planes.append(BitVector.of(np.packbits(bit), len(bit)))
            low = np.compress(~bit, cur)
            zeros.append(len(low))
            cur = np.concatenate([low, np.compress(bit, cur)])
        return cls(planes, zeros, len(ids))

    def bits(self, level: int) -> np.ndarray:
        return self.planes[level].bits()

    def decode(self) -> np.ndarray:
        """All ids, from the lowest plane back up."""
        cur = np.zeros(self.n, np.uint32 if len(self.planes) > 16 else np.uint16)
        for level in reversed(range(len(self.planes))):
            bit, z = self.bits(level), self.zeros[level]
            cur[z:] |= cur.dtype.type(1 << (len(self.planes) - 1 - level))
            up = np.empty_like(cur)
            up[np.flatnonzero(~bit)] = cur[:z]
            up[np.flatnonzero(bit)] = cur[z:]
            cur = up
        return cur.astype(np.uint32)

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        out = 0
        for plane, z in zip(self.planes, self.zeros):
            bit, ones = plane.get(i), plane.rank(i)
            i = z + ones if bit else i - ones
            out = out << 1 | bit
        return out

    def ranks(self, token: int, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``token`` among the first ``i`` ids, for many ``i``."""
        lo, hi = self._range(token, np.asarray(i, np.int64))
        return hi - lo

    def rank(self, token: int, i: int) -> int:
        return int(self.ranks(token, np.array([i]))[0])

    def _range(self, token: int, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo, hi, top = np.zeros(1, np.int64), i, len(self.planes) - 1
        if token >> (top + 1):
            return np.zeros_like(i), np.zeros_like(i)
        for level, (plane, z) in enumerate(zip(self.planes, self.zeros)):
            a, b = plane.ranks(lo), plane.ranks(hi)
            lo, hi = (z + a, z + b) if token >> (top - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the ``k``-th occurrence (from 0) of ``token``."""
        lo, hi = (int(x[0]) for x in self._range(token, np.array([self.n])))
        if not 0 <= k < hi - lo:
            raise IndexError(f"token {token} occurs {hi - lo} times")
        pos = lo + k
        for plane, z in zip(reversed(self.planes), reversed(self.zeros)):
            pos = plane.select(pos - z, 1) if pos >= z else plane.select(pos, 0)
        return pos

    def places(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]


# -- shard files -------------------------------------------------------------

class Shard(NamedTuple):
    """A shard read back: document ids, their last tokens, and the tokens."""
    doc_ids: list[int | None]
    last: BitVector
    tokens: WaveletMatrix

    def ends(self) -> np.ndarray:
        """Tokens before the end of each document."""
        return np.flatnonzero(self.last.bits()) + 1

    def counts(self, token: int) -> np.ndarray:
        """Occurrences of a token in each document: ranks at its bounds."""
        return np.diff(self.tokens.ranks(token, np.append(0, self.ends())))


def shard_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, bits: int) -> bytes:
    """Every document has one token at least (its end id)."""
    wm = WaveletMatrix.build(ids, bits)
    last = np.zeros(wm.n, bool)
    last[np.cumsum(lengths, dtype=np.int64) - 1] = True
    press = zstandard.ZstdCompressor(level=1)
    frames = [press.compress(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes())]
    vectors = []
    for vector in (BitVector.of(np.packbits(last), wm.n), *wm.planes):
        blocks = [press.compress(vector._load(k).tobytes()) for k in range(len(vector.before) - 1)]
        vectors.append({"frames": [len(x) for x in blocks], "before": vector.before.tolist()})
        frames += blocks
    head = json.dumps({"n": wm.n, "zeros": wm.zeros, "null_ids": [i for i, d in enumerate(doc_ids) if d is None],
                       "ids": len(frames[0]), "vectors": vectors}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, *frames])


def read_shard(data: bytes) -> Shard:
    """A shard; blocks of its planes are inflated as they are touched."""
    if data[:8] != MAGIC:
        raise ValueError("not a token shard")
    size = int.from_bytes(data[8:12], "little")
    head, at = json.loads(data[12:12 + size]), 12 + size

    def inflate(start: int, length: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(data[start:start + length])

    ids: list[int | None] = np.frombuffer(inflate(at, head["ids"]), "<i8").tolist()
    for i in head["null_ids"]:
        ids[i] = None
    at += head["ids"]
    vectors = []
    for v in head["vectors"]:
        starts = (at + np.cumsum([0, *v["frames"]])).tolist()
        at = starts[-1]
        vectors.append(BitVector(head["n"], np.array(v["before"], np.int64), lambda k, starts=starts: np.frombuffer(
            inflate(starts[k], starts[k + 1] - starts[k]), np.uint8)))
    return Shard(ids, vectors[0], WaveletMatrix(vectors[1:], head["zeros"], head["n"]))


# -- encoding ----------------------------------------------------------------

# normalizer and pre-tokenizer under which blanks are dropped and part words
# (fixed values of the tokenizer file)
_SPACE_DROPPED = (
    [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")
# punctuation that may follow a word and is a piece of its own (no apostrophe)
_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# words of A-Z and the letters from U+00C0 to U+00FF: in normal form as they
# are, and lower-cased letter by letter
_LATIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
WORDS_KEPT = 150_000
CORES_TOGETHER = 5_000


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the code points from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in own)}


class Encoder:
    """Texts to little-endian ids; words are encoded once and remembered (two
    generations of ``WORDS_KEPT`` words, so frequent words stay)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"        # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers
        if not os.path.isabs(path):
            import public_tokenizers
            path = public_tokenizers.path(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.whole = Tokenizer.from_file(path)
        vocab = self.whole.get_vocab(with_added_tokens=True)
        self.bits = max(1, max(vocab.values()).bit_length())
        self.dtype = np.dtype("<u2" if self.bits <= 16 else "<u4")
        normal, split = _SPACE_DROPPED
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_word = bool((spec.get("normalizer") or {}).get("normalizers") == normal
                            and pre[0].get("pattern", {}).get("Regex") == split and pre[0].get("invert")
                            and pre[0].get("behavior") == "Removed" and suffix)
        if self.by_word:
            # the model alone, for words whose normal form and piece are known;
            # a word ends with the token that carries the suffix
            self.model = Tokenizer(self.whole.model)
            self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
            self.letters = _byte_letters()
        self.cores: list[dict[bytes, bytes]] = [{}, {}]
        self.others: list[dict[bytes, bytes]] = [{}, {}]

    def _whole_ids(self, texts: list[bytes] | list[str]) -> list[bytes]:
        texts = [t.decode() if isinstance(t, bytes) else t for t in texts]
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def _core_ids(self, cores: list[bytes]) -> list[bytes]:
        """Ids of lower-case Latin words, encoded together."""
        if len(cores) > CORES_TOGETHER:
            return [x for i in range(0, len(cores), CORES_TOGETHER) for x in self._core_ids(cores[i:i + CORES_TOGETHER])]
        letters = " ".join(cores_text(cores, self.letters))
        ids = np.array(self.model.encode_batch_fast([letters], add_special_tokens=False)[0].ids, self.dtype)
        ends = (np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize
        if len(ends) != len(cores):
            raise ValueError("a word did not end with a suffix token")
        data, ends = ids.tobytes(), ends.tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _known(self, keys: list[bytes], encode, store: list[dict[bytes, bytes]]) -> list[bytes]:
        """Ids of each key, from the store's two generations or encoded now."""
        if len(store[0]) > WORDS_KEPT:
            store[:] = [{}, store[0]]
        new, old = store
        out = list(map(new.get, keys))
        missing = []
        for i, x in enumerate(out):
            if x is None:
                x = out[i] = old.get(keys[i])
                if x is None:
                    missing.append(i)
                else:
                    new[keys[i]] = x
        if missing:
            unknown = [keys[i] for i in missing]
            found = encode(unknown)
            new.update(zip(unknown, found))
            for i, x in zip(missing, found):
                out[i] = x
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and each text's number."""
        if not self.by_word:
            coded = self._whole_ids(["" if t is None else t for t in texts.to_pylist()])
            lengths = np.array([len(c) // self.dtype.itemsize for c in coded], np.int64)
            return np.frombuffer(b"".join(coded), self.dtype), lengths
        # words split by ASCII blanks; each distinct word of the batch once
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        first = split.offsets.to_numpy()
        words = split.values.slice(first[0], first[-1] - first[0]).dictionary_encode()
        distinct = words.dictionary
        # a Latin word and its punctuation are pieces of their own
        cut = pc.utf8_rtrim(distinct, characters=_TAIL)
        latin = pc.match_substring_regex(cut, _LATIN)
        tailed = pc.and_(latin, pc.less(pc.binary_length(cut), pc.binary_length(distinct)))
        cores = pc.utf8_lower(cut.filter(latin)).dictionary_encode()
        tails = pc.replace_substring_regex(distinct.filter(tailed), _LATIN[:-1], "").dictionary_encode()
        other = distinct.filter(pc.invert(latin))
        whole = _byte_list(other) + _byte_list(tails.dictionary)
        coded = self._known(_byte_list(cores.dictionary), self._core_ids, self.cores)
        n_cores = len(coded)
        coded += self._known(whole, self._whole_ids, self.others)
        pool = np.frombuffer(b"".join(coded), self.dtype)
        sizes = np.append(np.fromiter(map(len, coded), np.int64, len(coded)) // self.dtype.itemsize, 0)
        starts = np.cumsum(sizes) - sizes
        is_latin, has_tail = (x.to_numpy(zero_copy_only=False) for x in (latin, tailed))
        piece = np.full((len(distinct), 2), len(coded))           # the last piece is empty
        piece[is_latin, 0] = cores.indices.to_numpy()
        piece[~is_latin, 0] = n_cores + np.arange(len(other))
        piece[has_tail, 1] = n_cores + len(other) + tails.indices.to_numpy()
        # the distinct words' ids, then those of all words
        pool = pool[expand(starts[piece].ravel(), sizes[piece].ravel())]
        sizes = sizes[piece].sum(axis=1)
        at = words.indices.to_numpy()
        n = sizes[at]
        ids = pool[expand((np.cumsum(sizes) - sizes)[at], n)]
        return ids, np.diff(np.append(0, np.cumsum(n))[first - first[0]])


def _byte_list(strings: pa.Array) -> list[bytes]:
    return strings.cast(pa.binary()).to_pylist()


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... counts[i] times, for all i."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0, dtype=np.int32) + np.repeat(
        (starts - (ends - counts)).astype(np.int32), counts)


def cores_text(cores: list[bytes], letters: dict[int, str]) -> list[str]:
    """Byte-level spelling of Latin words."""
    return [c.decode() if c.isascii() else c.decode("latin-1").translate(letters) for c in cores]


def encoder(path: str) -> Encoder:
    return claim(__name__, path, lambda: Encoder(path))


def groups_of(sizes: np.ndarray, limit: int):
    """Ranges of texts of about ``limit`` bytes."""
    lo, ends = 0, np.cumsum(sizes)
    while lo < len(sizes):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield lo, hi
        lo = hi


def with_end_ids(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> np.ndarray:
    """The ids with the end id behind each text."""
    out = np.empty(len(ids) + len(lengths), ids.dtype)
    last = np.cumsum(lengths + 1) - 1
    inner = np.ones(len(out), bool)
    inner[last] = False
    out[inner] = ids
    out[last] = end_id
    return out


# -- operator ----------------------------------------------------------------

def write_tokens(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id",
                 tokenizer: str = "word_bpe_49k.json", end_id: int = 2,
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shards; the manifest (one row per shard file)."""
    root = scratch_dir(docs.sparkSession, "tokens")

    def run(batches):
        enc = encoder(tokenizer)
        part, seq = TaskContext.get().partitionId(), 0
        ids, lengths, tokens, held = [], [], [], 0

        def flush():
            nonlocal seq, ids, lengths, tokens, held
            path = f"{root}/part-{task_name()}-{seq:05d}.wvmx"
            flat = np.concatenate(tokens)
            data = shard_bytes(ids, lengths, flat, enc.bits)
            write_file(path, lambda f: f.write(data))
            row = record_batch(part=pa.array([part], pa.int32()), seq=pa.array([seq], pa.int32()),
                               path=pa.array([path]), n_docs=pa.array([len(ids)], pa.int64()),
                               n_tokens=pa.array([len(flat)], pa.int64()), n_bytes=pa.array([len(data)], pa.int64()))
            ids, lengths, tokens, held, seq = [], [], [], 0, seq + 1
            return row

        for batch in batches:
            texts = batch.column(1)
            for lo, hi in groups_of(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), GROUP_BYTES):
                coded, n = enc.encode(texts.slice(lo, hi - lo))
                coded = with_end_ids(coded, n, end_id)
                ends = np.append(0, np.cumsum(n + 1))
                names = batch.column(0).slice(lo, hi - lo).to_pylist()
                at = 0
                while at < len(names):
                    # documents up to the one that fills the shard
                    to = min(len(names), int(np.searchsorted(ends, ends[at] + shard_tokens - held)))
                    ids += names[at:to]
                    lengths += (n[at:to] + 1).tolist()
                    tokens.append(coded[ends[at]:ends[to]])
                    held += int(ends[to] - ends[at])
                    at = to
                    if held >= shard_tokens:
                        yield flush()
        if ids:
            yield flush()

    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("__id"),
                      F.col(f"`{text}`").cast("string").alias("__text"))
    ordered = (src.repartitionByRange(F.col("__id").asc_nulls_first())
               .sortWithinPartitions(F.col("__id").asc_nulls_first(), F.col("__text").asc_nulls_first()))
    return write_scratch(ordered.mapInArrow(run, MANIFEST), "token_manifest")


def read_tokens(manifest: DataFrame, *, id_col: str = "doc_id", end_id: int = 2) -> DataFrame:
    """Read the shard files of a manifest: per document its id, ``start``
    (ids of all documents before it), ``n_tokens``, ``ids_crc32``, and
    ``n_end_ids``, how often the end id stands in it."""
    whole = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = whole.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    shards = (manifest.withColumn("inside", inside).join(before, "part")
              .select("path", (F.col("before") + F.col("inside")).alias("start")))

    def run(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = read_shard(read_file(path))
                ends = shard.ends()
                first = np.append(0, ends[:-1])
                data = memoryview(shard.tokens.decode().astype("<u4").tobytes())
                crc = [zlib.crc32(data[4 * a:4 * e]) for a, e in zip(first.tolist(), ends.tolist())]
                yield record_batch(id=pa.array(shard.doc_ids, pa.int64()), start=pa.array(start + first, pa.int64()),
                                   n=pa.array(ends - first, pa.int64()), crc=pa.array(crc, pa.int64()),
                                   e=pa.array(shard.counts(end_id), pa.int64()))

    tasks = max(1, min(manifest.count(), 4 * manifest.sparkSession.sparkContext.defaultParallelism))
    return shards.repartition(tasks).mapInArrow(
        run, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long, n_end_ids long")


def token_output(docs: DataFrame, **options) -> DataFrame:
    """Write the shards and read them back."""
    return read_tokens(write_tokens(docs, **options), id_col=options.get("id_col", "doc_id"),
                       end_id=options.get("end_id", 2))


def token_counts(manifest: DataFrame, tokens: list[int], *, id_col: str = "doc_id") -> DataFrame:
    """token, document id and ``n`` for every document that holds one of the
    tokens, from ranks alone: no shard is decoded."""
    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                shard = read_shard(read_file(path))
                for token in tokens:
                    n = shard.counts(token)
                    hit = np.flatnonzero(n)
                    yield record_batch(token=pa.array(np.full(len(hit), token), pa.int64()),
                                       id=pa.array([shard.doc_ids[i] for i in hit.tolist()], pa.int64()),
                                       n=pa.array(n[hit], pa.int64()))

    return manifest.select("path").mapInArrow(run, f"token long, `{id_col}` long, n long")
