"""Token ids in a content-addressed store.

A rolling hash over the ids cuts every document's id stream into chunks; each distinct
chunk is stored once under its SHA-256; a document is a recipe, the list of its chunks'
keys; Merkle roots over the recipes, kept in manifests, show that what is read back is
what was written.

Files under the store's folder, all Parquet: ``chunks`` (key binary, ids binary: unsigned
little-endian integers of ``width`` bytes), ``recipes`` (part, doc_id, start, n_tokens,
keys, root; the files of a part in order hold ascending doc_ids), ``manifest`` (part,
first_doc, n_docs, start, n_tokens, root) and ``top`` (width, n_tokens, root).
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from array import array
from bisect import bisect_left
from codecs import charmap_decode
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BATCH_ROWS, bit_filter, map_rows, may_hold, process_memory, shared_dir, small_batches, stash, unstash

END_ID = 0
#: Ids in a chunk: the least, the most, and the bits of the hash that must be zero at a cut.
LEAST, MOST, MASK_BITS, REACH = 64, 4096, 9, 16
#: Words remembered by a worker process before those are set aside that were not used since the
#: last time, and those set aside then are forgotten.
MEMORY = 3 << 18
#: Bytes of texts that a task codes at once, as far as batches are whole.
GATHERED = 5 << 20
#: Bits of the broadcast filter of keys that several tasks have (a power of two).
FILTER_BITS = 1 << 24
#: How chunks are written: hardly any of them is there twice, so dictionaries would be made in vain.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary": "false"}
_MIX, _BASE = np.uint64(0x9E3779B97F4A7C15), 0xD6E8FEB86659FD93
#: One space between two characters that are no white space: the tokenizer's own pattern always
#: cuts before it, and never looks back, so both sides can be encoded apart.
SPLIT = re.compile(r"(?<=\S) (?=\S)").split
#: Where this occurs, a run of white space would be cut within; elsewhere each single space is such a place.
RUN = re.compile(r" (?<=\s )\s").search  # begins with a plain character, as these are found faster
#: A word of Latin letters, then punctuation: the pattern cuts between the two, and nowhere else.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
#: Those of words with a space between each two that are Latin letters only.
LETTERS = re.compile(r"(?<![^ ])[A-Za-zÀ-ÖØ-öø-ɏ]+(?![^ ])").findall
#: A line feed between two characters that are no white space is always cut off on both sides.
LINE = re.compile(r"(?<=\S)\n(?=\S)").split


def _alphabet() -> str:
    """The byte-level alphabet, by byte: bytes that print stand for themselves, the others follow from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(prints)]
    found = {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return "".join(found[b] for b in range(256))


class _Words(dict):
    """Words to packed ids, as if a space (or, after LINE_MARK, a line feed) went before.

    Most words are seen once: so what is full is not emptied but set aside, and words that are
    used again come back from there. No more than twice MEMORY words are held."""

    def __init__(self, coder: Coder):
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.coder, self.table, self.model = coder, _alphabet(), coder.library.model
        self.code = {array(c).itemsize: c for c in "HIL"}[coder.width]

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMORY:
            self.older = {**self}
            self.clear()
        if (out := self.older.pop(word, None)) is not None:
            self[word] = out
            return out
        if word.isascii() and word.isalpha():
            self[word] = out = array(self.code, [t.id for t in self.model.tokenize("Ġ" + word)]).tobytes()
            return out
        head = word[:1] == LINE_MARK
        body = word[1:] if head else word
        if head and body.isascii() and body.isalpha():
            self[word] = out = array(self.code, [t.id for t in self.model.tokenize(body)]).tobytes()
            return out
        lead = "" if head else " "
        if (m := PLAIN(body)) is not None:
            core, tail = m.groups()
            out = self[word[: len(word) - len(tail)]] + self[TAIL_MARK + tail] if tail else self.one(lead + core)
        elif body[:1] == TAIL_MARK:
            out = self.coder.pack([body[1:]])[0]
        elif len(parts := LINE(body)) > 1:  # hardly ever seen again, so not remembered as a whole
            return self[word[:1] * head + parts[0]] + b"".join([self.coder.line + self[LINE_MARK + x] for x in parts[1:]])
        else:
            out = self.coder.pack([lead + body])[0]
        self[word] = out
        return out

    def meet(self, words: list[str]) -> None:
        """Learn those of different, unknown words that are Latin letters only, as far as there is room: one by
        one, finding out what they are and spelling them in the byte-level alphabet takes as long as the model."""
        new = LETTERS(" ".join([w for w in words if w not in self.older]))
        if not new or len(self) + len(new) > MEMORY:
            return
        tokenize, code = self.model.tokenize, self.code
        for word, spelt in zip(new, charmap_decode(" ".join(new).encode(), "strict", self.table)[0].split("Ġ"), strict=True):
            self[word] = array(code, [t.id for t in tokenize("Ġ" + spelt)]).tobytes()

    def one(self, piece: str) -> bytes:
        """A single piece of the pattern, by the library's model."""
        return array(self.code, [t.id for t in self.model.tokenize(charmap_decode(piece.encode(), "strict", self.table)[0])]).tobytes()


#: Characters that are no characters of Unicode text, so they name other readings of a word.
LINE_MARK, TAIL_MARK = "\ufdd0", "\ufdd1"
#: A comma or full stop at the end of a word of Latin letters, and LINE's line feed, each made a word of its
#: own: words are then known with all that may follow them. Both are cut off by the pattern wherever they match.
STOP, STOPPED = re.compile(r"[,.](?<=[A-Za-zÀ-ÖØ-öø-ɏ].)(?=[ \n]\S|\Z)").sub, rf" {TAIL_MARK}\g<0>"
FEED, FED = re.compile(r"\n(?<=\S\n)(?=\S)").sub, f" {TAIL_MARK}\n {LINE_MARK}"


class Coder:
    """Whole-text encoding with the tokenizers library, remembering words it has encoded.

    Words are cut only where the byte-level pattern always cuts; a model whose pre-tokenizer
    is another one gets whole texts, and so do texts that hold the literal of an added token
    (which the library makes one id, unless ``literal``) or a character used as a mark here.
    """

    def __init__(self, spec: bytes, literal: bool = False):
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec.decode())
        self.library.encode_special_tokens = literal
        self.library.no_truncation()
        known = json.loads(spec)
        pre = known.get("pre_tokenizer") or {}
        whole = not (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not known.get("normalizer") and known["model"].get("type", "BPE") == "BPE" and not known["model"].get("dropout"))
        added = [t["content"] for t in known.get("added_tokens") or () if not (literal and t["special"])]
        self.apart = [""] if whole else [LINE_MARK, TAIL_MARK, *added]
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.line = self.pack(["\n"])[0]
        self.words = _Words(self)

    def pack(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, f"<u{self.width}").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Words are cut, told apart and put together again by Arrow for all texts
        at once, so that each different word is looked up once, however often it occurs."""
        found, out, plain = self.words.__getitem__, [b""] * len(texts), []
        for i, t in enumerate(texts):
            if any([x in t for x in self.apart]):
                out[i] = self.pack([t])[0]
            elif RUN(t):
                first, *rest = SPLIT(t)
                out[i] = found(LINE_MARK + first) + b"".join(map(found, rest))
            else:
                plain.append(i)
        if plain:
            words = pc.split_pattern(pa.array([LINE_MARK + FEED(FED, STOP(STOPPED, texts[i])) for i in plain], pa.large_string()), " ")
            told = words.flatten().dictionary_encode()
            # one string cut at its spaces, which no word has, is faster than as many Arrow values
            whole = pa.ListArray.from_arrays(pa.array([0, len(told.dictionary)], pa.int32()), told.dictionary)
            known = pc.binary_join(whole, pa.scalar(" ", pa.large_string()))[0].as_py().split(" ")
            got = list(map(self.words.get, known))
            new = [i for i, x in enumerate(got) if x is None]
            self.words.meet([known[i] for i in new])
            for i in new:
                got[i] = found(known[i])
            coded = pa.array(got, pa.large_binary()).take(told.indices)
            joined = pc.binary_join(pa.ListArray.from_arrays(words.offsets, coded), pa.scalar(b"", pa.large_binary()))
            for i, ids in zip(plain, joined.to_pylist(), strict=True):
                out[i] = ids
        return out


def _coder(spec: bytes, literal: bool) -> Coder:
    held = process_memory("coders")
    key = hash(spec), literal
    if key not in held:
        held[key] = Coder(spec, literal)
    return held[key]


def gathered(batches: Iterator[pa.RecordBatch], size: int = GATHERED) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``size`` bytes or a little more: the more texts are coded together,
    the fewer words are looked up."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.nbytes
        if n >= size:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def places(ids: np.ndarray, bits: int = MASK_BITS) -> np.ndarray:
    """Where the hash of the last REACH ids has ``bits`` leading zeros (one past the last)."""
    n = len(ids)
    x = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    x ^= x >> np.uint64(29)
    h, j, p = x, 1, _powers(REACH)
    while j < REACH:  # a power of two: the hash of 2 * j ids is made of those of j
        x, h = h, h.copy()
        h[j:] += x[: max(n - j, 0)] * p[j]
        j *= 2
    return np.flatnonzero((h >> np.uint64(64 - bits)) == 0) + 1


def cuts(lengths: list[int], found: list[int], least: int = LEAST, most: int = MOST) -> list[list[int]]:
    """For streams of these lengths laid end to end, and the places() of the whole, the ends of
    each one's chunks, from its own start: the first place at least ``least`` ids on, ``most``
    ids on at the latest. No window of REACH ids that ends there reaches into another stream."""
    if least < REACH:
        raise ValueError("chunks must be longer than the hash's reach")
    out, start = [], 0
    for n in lengths:
        ends, at = [], start
        while at < start + n:
            k = bisect_left(found, at + least)
            at = min(found[k] if k < len(found) else start + n, at + most, start + n)
            ends.append(at - start)
        out.append(ends)
        start += n
    return out


def merkle(keys: list[bytes]) -> bytes:
    """Root over a list of hashes; leaves and inner nodes have different prefixes."""
    level = [hashlib.sha256(b"\0" + k).digest() for k in keys] or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        pairs = [hashlib.sha256(b"\1" + level[i] + level[i + 1]).digest() for i in range(0, len(level) - 1, 2)]
        level = pairs + ([level[-1]] if len(level) % 2 else [])
    return level[0]


class Tree:
    """merkle() over hashes that come one by one: keeps one root for each full subtree only."""

    def __init__(self):
        self.full: list[tuple[int, bytes]] = []

    def add(self, key: bytes) -> None:
        size, root = 1, hashlib.sha256(b"\0" + key).digest()
        while self.full and self.full[-1][0] == size:
            size, root = 2 * size, hashlib.sha256(b"\1" + self.full.pop()[1] + root).digest()
        self.full.append((size, root))

    def root(self) -> bytes:
        out = None
        for _, root in reversed(self.full):
            out = root if out is None else hashlib.sha256(b"\1" + root + out).digest()
        return hashlib.sha256(b"").digest() if out is None else out


def _leaf(doc_id: int | None, start: int, n_tokens: int, root: bytes) -> bytes:
    return f"{doc_id} {start} {n_tokens} ".encode() + root


def part_roots(recipes: DataFrame) -> DataFrame:
    """(part, first_doc, n_docs, n_tokens, root) of every part of the recipes: the root is over
    (doc_id, start, n_tokens, root) of its documents in the order of start. A part is streamed;
    starts that don't follow from the lengths before them raise."""
    schema = "part int, first_doc long, n_docs long, n_tokens long, root binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found = None, []
        for b in batches:
            for part, doc, start, n, root in zip(*(b.column(c).to_pylist() for c in ("part", "doc_id", "start", "n_tokens", "root")), strict=True):
                if part != now:
                    found += [(now, first, docs, at, tree.root())] if now is not None else []
                    now, first, docs, at, tree = part, doc, 0, 0, Tree()
                if start != at:
                    raise ValueError(f"part {part}: a recipe is missing or was added before id {start}")
                tree.add(_leaf(doc, start, n, root))
                docs, at = docs + 1, at + n
        found += [(now, first, docs, at, tree.root())] if now is not None else []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["part", "first_doc", "n_docs", "n_tokens", "root"])

    small_batches(recipes.sparkSession)
    rows = recipes.select("part", "doc_id", "start", "n_tokens", "root").repartition("part").sortWithinPartitions("part", "start")
    return rows.mapInArrow(run, schema)


def write_store(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", literal: bool = False, bits: int = FILTER_BITS) -> None:
    """Encode all rows' whole texts and write the store.

    Ids are the library's with add_special_tokens=False; where a text holds the literal of an
    added token it becomes that token's id as the library does by default, or ordinary text
    with ``literal``. Null and empty texts are the end id alone. Rows with the same doc_id keep
    one recipe each, in the order of their first chunk keys; rows with a null doc_id come first.
    An empty table gives an empty store. Other columns are not read.

    A task sends equal chunks once. Which keys more than one task has follows from the keys
    alone; only the chunks of such keys are shuffled (those that a filter of fixed size takes for
    one, too), all others go from where they were cut to their file. Recipes (keys only) are
    dealt by doc_id.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:
        raw = f.read()
    spec = spark.sparkContext.broadcast(raw)  # a vocabulary file: its size is fixed
    width = Coder(raw).width
    end = int(end_id).to_bytes(width, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, sent = _coder(spec.value, literal), set()
        for b in gathered(batches):
            coded = [ids + end for ids in coder.encode([t or "" for t in b.column(1).to_pylist()])]
            for lo in range(0, len(coded), BATCH_ROWS):
                some = coded[lo : lo + BATCH_ROWS]
                keys_of, blobs_of, counts = [], [], []
                if len(sent) > 1 << 20:
                    sent.clear()
                found = places(np.frombuffer(b"".join(some), f"<u{width}")).tolist()
                for ids, stops in zip(some, cuts([len(x) // width for x in some], found), strict=True):
                    at, keys, blobs = 0, [], []
                    for stop in stops:
                        blob = ids[at * width : stop * width]
                        key = hashlib.sha256(blob).digest()
                        keys.append(key)
                        blobs.append(None if key in sent else blob)
                        sent.add(key)
                        at = stop
                    keys_of.append(keys)
                    blobs_of.append(blobs)
                    counts.append(at)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, len(some)), pa.array(counts, pa.int64()), pa.array(keys_of, pa.list_(pa.binary())), pa.array(blobs_of, pa.list_(pa.binary()))], ["doc_id", "n_tokens", "keys", "blobs"])

    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    coded = stash(rows.mapInArrow(run, "doc_id long, n_tokens long, keys array<binary>, blobs array<binary>"), "token-chunks", dictionary=False)
    pieces = coded.select(F.explode(F.arrays_zip("keys", "blobs")).alias("c")).where("c.blobs IS NOT NULL").select(F.col("c.keys").alias("key"), F.col("c.blobs").alias("ids"))
    twice = coded.select(F.explode(F.arrays_zip("keys", F.transform("blobs", lambda x: x.isNotNull()).alias("here"))).alias("c")).where("c.here").groupBy(F.col("c.keys").alias("k")).agg(F.count("*").alias("n")).where("n > 1")
    held = spark.sparkContext.broadcast(bit_filter(twice.select(F.xxhash64("k").alias("key")), bits))

    @F.pandas_udf("boolean")
    def shared(h: pd.Series) -> pd.Series:
        return pd.Series(may_hold(held.value, h.to_numpy(np.int64).view(np.uint64)))

    marked = pieces.withColumn("shared", shared(F.xxhash64("key")))
    marked.where("NOT shared").select("key", "ids").write.options(**PACKED).parquet(f"{folder}/chunks")
    marked.where("shared").select("key", "ids").dropDuplicates(["key"]).write.mode("append").options(**PACKED).parquet(f"{folder}/chunks")

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.column("n_tokens").to_numpy()
            ends = start + np.cumsum(n)
            roots = [merkle(k) for k in b.column("keys").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), part, np.int32)), b.column("doc_id"), pa.array(ends - n), pa.array(n), b.column("keys"), pa.array(roots, pa.binary())], ["part", "doc_id", "start", "n_tokens", "keys", "root"])
            start = int(ends[-1]) if len(n) else start

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = coded.select("doc_id", "n_tokens", "keys").repartitionByRange(parts, "doc_id", F.xxhash64("keys")).sortWithinPartitions("doc_id", F.xxhash64("keys"), "keys")
    ordered.mapInArrow(order, "part int, doc_id long, start long, n_tokens long, keys array<binary>, root binary").write.parquet(f"{folder}/recipes")
    unstash(coded)
    start, lines = 0, []
    for part, first, n_docs, n, root in sorted(part_roots(spark.read.parquet(f"{folder}/recipes")).collect()):  # a row for each partition
        lines.append((part, first, n_docs, start, n, root))
        start += n
    spark.createDataFrame(lines, "part int, first_doc long, n_docs long, start long, n_tokens long, root binary").coalesce(1).write.parquet(f"{folder}/manifest")
    spark.createDataFrame([(width, start, merkle([bytes(x[-1]) for x in lines]))], "width int, n_tokens long, root binary").coalesce(1).write.parquet(f"{folder}/top")


def verify_manifest(spark: SparkSession, folder: str) -> int:
    """Hold the recipes against the manifest and the manifest against the top; the ids' width.
    A recipe that was lost, added, moved or changed raises."""
    top = spark.read.parquet(f"{folder}/top").first()
    rows = sorted(spark.read.parquet(f"{folder}/manifest").collect())  # a row for each partition
    found = sorted(part_roots(spark.read.parquet(f"{folder}/recipes")).collect())
    if [(r.part, r.first_doc, r.n_docs, r.n_tokens, r.root) for r in rows] != [tuple(r) for r in found]:
        raise ValueError("the recipes are not those of the manifest")
    starts = np.cumsum([0, *(r.n_tokens for r in rows)]).tolist()
    if [r.start for r in rows] != starts[:-1] or top["n_tokens"] != starts[-1] or bytes(top["root"]) != merkle([bytes(r.root) for r in rows]):
        raise ValueError("the manifest is not that of the top")
    return top["width"]


_POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo CRC-32's (bit-reversed)."""
    out = 0
    for i in range(31, -1, -1):
        if a >> i & 1:
            out ^= b
        b = (b >> 1) ^ (_POLY if b & 1 else 0)
    return out


class Shift:
    """x ** (8 * n bytes) modulo CRC-32's polynomial, remembered by n."""

    def __init__(self):
        self.known: dict[int, int] = {0: 1 << 31}

    def __call__(self, n: int) -> int:
        if n not in self.known:
            out, power, k = 1 << 31, 1 << 23, n
            while k:
                if k & 1:
                    out = _times(out, power)
                power, k = _times(power, power), k >> 1
            self.known[n] = out
        return self.known[n]


def join_crcs(parts: list[tuple[int, int]], shift: Shift) -> int:
    """crc32 of a concatenation from (crc32, bytes) of its parts."""
    total = 0
    for crc, n in parts:
        total = _times(shift(n), total) ^ crc if total else crc  # nothing goes before the first part
    return total


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    manifest = spark.read.parquet(f"{folder}/manifest").select("part", F.col("start").alias("before"))
    recipes = spark.read.parquet(f"{folder}/recipes").join(F.broadcast(manifest), "part")  # a row for each partition
    return recipes.select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "keys", "root")


def _check_key(key: bytes, blob: bytes) -> bytes:
    if hashlib.sha256(blob).digest() != key:
        raise ValueError(f"chunk {key.hex()} does not have its key")
    return blob


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every recipe, from the files.

    Recipes are held against the manifest, the manifest against the top. Every distinct chunk is
    read, held against its key and measured once; a document's sum is put together from its
    chunks' sums and lengths, so a chunk that a third of all documents share travels as a few
    numbers. A chunk whose bytes do not have its key, a missing chunk, a recipe whose root or
    length differs raises.
    """
    width = verify_manifest(spark, folder)
    small_batches(spark)

    def measure(cols: dict) -> dict:
        blobs = [_check_key(k, b) for k, b in zip(cols["key"].to_pylist(), cols["ids"].to_pylist(), strict=True)]
        return {"key": cols["key"], "n": [len(b) // width for b in blobs], "crc": [zlib.crc32(np.frombuffer(b, f"<u{width}").astype("<u4").tobytes()) for b in blobs]}

    chunks = map_rows(spark.read.parquet(f"{folder}/chunks"), "key binary, n int, crc long", measure)
    rows = _placed(spark, folder).select("start", "doc_id", "n_tokens", "root", F.posexplode("keys").alias("pos", "key"))
    joined = rows.join(chunks, "key", "left").groupBy("start", "doc_id", "n_tokens", "root").agg(F.sort_array(F.collect_list(F.struct("pos", "key", "n", "crc"))).alias("c"))

    def check(cols: dict) -> dict:
        shift, out = process_memory("crc").setdefault("shift", Shift()), []
        c = cols["c"]
        flat, ends = c.flatten(), c.value_lengths().to_numpy().cumsum().tolist()
        keys, (n, crc) = flat.field(1).to_pylist(), (flat.field(i).fill_null(-1).to_numpy().tolist() for i in (2, 3))
        lo = 0
        for n_tokens, root, hi in zip(cols["n_tokens"].to_pylist(), cols["root"].to_pylist(), ends, strict=True):
            if -1 in crc[lo:hi] or sum(n[lo:hi]) != n_tokens or merkle(keys[lo:hi]) != root:
                raise ValueError("a recipe cannot be put together as it was written")
            out.append(join_crcs([(x, 4 * k) for x, k in zip(crc[lo:hi], n[lo:hi], strict=True)], shift))
            lo = hi
        return {"doc_id": cols["doc_id"], "start": cols["start"], "n_tokens": cols["n_tokens"], "ids_crc32": out}

    return map_rows(joined, "doc_id long, start long, n_tokens long, ids_crc32 long", check)


def read_ids(spark: SparkSession, folder: str, where: str | None = None) -> DataFrame:
    """doc_id, start, ids array<int>: documents put together again from their chunks, with the
    checks of read_digests()."""
    width = verify_manifest(spark, folder)
    recipes = _placed(spark, folder)
    recipes = recipes.where(where) if where else recipes
    rows = recipes.select("doc_id", "start", "n_tokens", "root", F.posexplode("keys").alias("pos", "key"))
    whole = rows.join(spark.read.parquet(f"{folder}/chunks"), "key", "left").groupBy("start", "doc_id", "n_tokens", "root").agg(F.sort_array(F.collect_list(F.struct("pos", "key", "ids"))).alias("c"))

    def build(cols: dict) -> dict:
        out = []
        for n, root, c in zip(cols["n_tokens"].to_pylist(), cols["root"].to_pylist(), cols["c"].to_pylist(), strict=True):
            if any(x["ids"] is None for x in c) or merkle([x["key"] for x in c]) != root:
                raise ValueError("a recipe cannot be put together as it was written")
            out.append(np.frombuffer(b"".join(_check_key(x["key"], x["ids"]) for x in c), f"<u{width}").astype(np.int32))
            if len(out[-1]) != n:
                raise ValueError("a recipe cannot be put together as it was written")
        return {"doc_id": cols["doc_id"], "start": cols["start"], "ids": out}

    return map_rows(whole, "doc_id long, start long, ids array<int>", build)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row of documents, read from a store written
    for the call; null and empty texts are the end id alone."""
    folder = f"{shared_dir(spark)}/token-store-{uuid.uuid4().hex}"
    write_store(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, default_tokenizer())
    return read_digests(spark, folder)
