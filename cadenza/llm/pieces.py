"""SentencePiece encoding and decoding by a streaming Viterbi search.

Characters are read from left to right. For every boundary the search keeps one
backpointer, in a window bounded by the longest piece; whenever the paths of all boundaries
that later pieces can still start from converge on one boundary, the ids before it are
committed and forgotten.

The path rule follows the kind of the model file. Unigram models: the greatest sum of piece
scores. BPE models: a piece may follow another only if the merge rules leave this pair as
it is; exactly one piece that ends at a boundary is then allowed, and the path is the
library's own encoding, not merely the one with the best sum.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from .common import map_rows, process_memory

SPACE = "▁"
#: Words and pairs remembered by one task; beyond that the memory is emptied and filled anew.
MEMORY = 1 << 18
#: Longer words are not remembered.
LONG = 64


def _kind(model: bytes) -> int:
    """trainer_spec.model_type of a model file (1 unigram, 2 BPE); fields are protobuf's."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = model[at]
            value |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return value, at

    def fields(at: int, end: int):
        while at < end:
            key, at = varint(at)
            if key & 7 == 0:
                value, at = varint(at)
                yield key >> 3, value, value
            elif key & 7 == 2:
                n, at = varint(at)
                yield key >> 3, at, at + n
                at += n
            else:
                at += 4 if key & 7 == 5 else 8

    for number, lo, hi in fields(0, len(model)):
        if number == 2:  # trainer_spec
            return next((a for n, a, _ in fields(lo, hi) if n == 3), 1)
    return 1


#: A word of letters, then of characters that are none.
LETTERS = re.compile(r"([^\W\d_]+)(\W+)").fullmatch


def pack(ids: Iterable[int]) -> bytes:
    return array("i", ids).tobytes()


class _Words(dict):
    """Words to packed ids, as if ``lead`` went before them."""

    def __init__(self, model: PieceModel, lead: str, apart: bool):
        super().__init__()
        self.model, self.lead, self.apart = model, lead, apart

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMORY:
            self.clear()
        if self.apart and (m := LETTERS(word)) is not None and m[1].isalpha():
            out = self[m[1]] + self.model.ends[m[2]]
        else:
            out = pack(self.model.number(self.model.stream(self.lead + word)))
        if len(word) <= LONG:
            self[word] = out
        return out


class PieceModel:
    """A model file, with encode(text) and decode(ids)."""

    def __init__(self, model: bytes):
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        self.bpe, kind = (kind := _kind(model)) == 2, kind
        if kind not in (1, 2):
            raise ValueError("only unigram and BPE models are supported")
        self.piece = [sp.id_to_piece(i) for i in range(size)]
        self.unk, self.score, self.ids, self.bytes = sp.unk_id(), {}, {}, {}
        self.byte_of: dict[int, int] = {}
        for i, p in enumerate(self.piece):
            if sp.is_byte(i):
                self.bytes[int(p[3:5], 16)] = i
                self.byte_of[i] = int(p[3:5], 16)
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[p], self.score[p] = i, sp.get_score(i)
        self.shown = {i: self.piece[i].replace(SPACE, " ") for i in self.ids.values()} | {i: chr(b) for i, b in self.byte_of.items() if b < 128}
        self.hidden = {i for i in range(size) if sp.is_control(i)}
        self.longest = max(map(len, self.ids))
        self.unknown_score = min(self.score.values()) - 10
        #: automaton of the longer pieces: what was read last names a node, [next nodes by character,
        #: (length, piece, known left neighbours) of the pieces that end here, name]; made when first met
        self.starts = {p[:n] for p in self.ids for n in range(1, len(p) + 1)}
        self.nodes: dict[str, list] = {}
        self.left_of: dict[str, dict[str, bool]] = {}
        inner = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        #: where no piece reaches across, all paths meet: the text may be cut there beforehand
        self.cut = None if inner else re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+\\Z").findall
        self.plain = sp.normalize("  a　ﬁ  B ") == SPACE + "  a　ﬁ  B ".replace(" ", SPACE)
        #: where no piece has a letter before another character, a word may be cut there, too
        apart = (self.bytes or self.bpe) and not any(a.isalpha() and not b.isalpha() for p in self.ids for a, b in zip(p, p[1:], strict=False))
        self.words, self.ends = _Words(self, SPACE, apart), _Words(self, "", False)
        self.n_pairs, self.root = 0, self.node("")

    def normal(self, text: str) -> str:
        if not text:
            return ""
        return SPACE + text.replace(" ", SPACE) if self.plain else self.sp.normalize(text).replace(" ", SPACE)

    def merged(self, text: str) -> list[str]:
        """Merge rules by definition: the best-scored pair first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def node(self, name: str) -> list:
        while name and name not in self.starts:
            name = name[1:]
        if name not in self.nodes:
            ends = [name[k:] for k in range(len(name) - 1) if name[k:] in self.ids]
            self.nodes[name] = [{}, [(len(p), p, self.left_of.setdefault(p, {})) for p in ends], name]
        return self.nodes[name]

    def fits(self, known: dict[str, bool], left: str, right: str) -> bool:
        """Whether merging leaves this pair of pieces as it is (left may be empty)."""
        if self.n_pairs >= MEMORY:
            for x in self.left_of.values():
                x.clear()
            self.n_pairs = 0
        self.n_pairs += 1
        known[left] = out = self.merged(left + right) == ([left, right] if left else [right])
        return out

    def extend(self, text: str, ends: list[str], sums: list[float], nodes: list[list]) -> None:
        """Backpointers of the boundaries of text that have none yet: ends[i] is the piece
        that ends at i (ends[0]: the last committed one), sums[i] the best sum (unigram),
        nodes[i] the automaton's node there."""
        i, score, fits, node = len(ends) - 1, self.score, self.fits, nodes[-1]
        for c in text[i:]:
            i += 1
            then = node[0].get(c)
            if then is None:
                then = node[0][c] = self.node(node[2] + c)
            node, take = then, c
            if self.bpe:
                for n, p, known in node[1]:
                    if n <= i:
                        left = ends[i - n]
                        ok = known.get(left)
                        if ok or ok is None and fits(known, left, p):
                            take = p
                            break
            else:
                best = sums[i - 1] + score.get(c, self.unknown_score)
                for n, p, _ in node[1]:
                    if n <= i and sums[i - n] + score[p] > best:
                        best, take = sums[i - n] + score[p], p
                sums.append(best)
            ends.append(take)
            nodes.append(node)

    def stream(self, text: str) -> Iterable[str]:
        """The committed pieces of a text, read window by window."""
        step = 4 * self.longest
        window, ends, sums, nodes = "", [""], [0.0], [self.root]
        for at in range(0, len(text), step):
            window += text[at : at + step]
            self.extend(window, ends, sums, nodes)
            if at + step >= len(text):
                break
            live = set(range(len(window) - self.longest + 1, len(window) + 1))
            while len(live) > 1:  # follow the backpointers until all paths are one
                x = max(live)
                live.discard(x)
                live.add(x - len(ends[x]))
            meet = live.pop()
            if meet:
                yield from self.path(ends, meet)
                window, ends, sums, nodes = window[meet:], ends[meet:], sums[meet:], nodes[meet:]
        yield from self.path(ends, len(window))

    @staticmethod
    def path(ends: list[str], end: int) -> list[str]:
        out = []
        while end > 0:
            out.append(ends[end])
            end -= len(ends[end])
        out.reverse()
        return out

    def learn(self, words: Iterable[str]) -> None:
        """Remember words not known yet. In sorted order a word goes on from the boundaries of
        what it has in common with the one before."""
        was, ends, sums, nodes, known = "", [""], [0.0], [self.root], self.words
        for w in sorted(words):
            w, k = SPACE + w, 0
            for a, b in zip(was, w, strict=False):
                if a != b:
                    break
                k += 1
            del ends[k + 1 :], sums[k + 1 :], nodes[k + 1 :]
            self.extend(w, ends, sums, nodes)
            known[w[1:]] = pack(self.number(self.path(ends, len(w))))
            was = w

    def number(self, pieces: Iterable[str]) -> tuple[int, ...]:
        pieces = list(pieces)
        try:
            return tuple(map(self.ids.__getitem__, pieces))
        except KeyError:
            pass
        out: list[int] = []
        unknown = False
        for p in pieces:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out.extend(self.bytes[b] for b in p.encode("utf-8", "surrogatepass"))
            elif not unknown or self.bpe:
                out.append(self.unk)
            unknown = i is None
        return tuple(out)

    def packed(self, text: str) -> bytes:
        """The ids of a whole text, as 32-bit integers."""
        if not text:
            return b""
        if self.cut is None:
            return pack(self.number(self.stream(self.normal(text))))
        if self.simple(text):
            return b"".join(map(self.words.__getitem__, text.split(" ")))
        return b"".join(self.words[w[1:]] if w[:1] == SPACE else pack(self.number(self.stream(w))) for w in self.cut(self.normal(text)))

    def simple(self, text: str) -> bool:
        """Whether the text's words are what single spaces separate."""
        return self.cut is not None and self.plain and text != "" and SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " "

    def packed_all(self, texts: list[str]) -> list[bytes]:
        """packed() of each text; new words of all are learned together."""
        new = {w for t in texts if self.simple(t) for w in t.split(" ")}.difference(self.words)
        if len(self.words) + len(new) > MEMORY:
            self.words.clear()
        cores = {m[1] if self.words.apart and (m := LETTERS(w)) is not None else w for w in new}
        self.learn(w for w in cores.difference(self.words) if w.isalpha() and len(w) <= LONG)
        return [self.packed(t) for t in texts]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        try:
            text = "".join([self.shown[i] for i in ids])
        except KeyError:  # bytes, control ids, the unknown one, or none of the model's
            text = self.spelled(ids)
        return text[1:] if text[:1] == " " else text

    def spelled(self, ids: Iterable[int]) -> str:
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i == self.unk:
                out.append(" ⁇ ")
            elif i not in self.hidden:
                out.append(self.piece[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out).replace(SPACE, " ")


def _coder(model: bytes) -> PieceModel:
    """One model, with what it remembers, for all tasks of a worker process."""
    held = process_memory("pieces")
    key = hash(model)
    if key not in held:
        held[key] = PieceModel(model)
    return held[key]


def _model(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())  # a vocabulary file: its size is fixed


def encode(df: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", check_col: str | None = None) -> DataFrame:
    """Adds ids array<int>, n_tokens int: whole texts, null as an empty one (no ids).

    With ``check_col`` also whether decoding the ids gives the text back (for null: the empty
    one), found where the text is encoded. A text longer than any window is streamed; only its
    ids are held. A literal U+2581 in a text reads as a space when decoded, as with the
    library. All other columns stay.
    """
    model = _model(df.sparkSession, model_path)
    rest = [c for c in df.columns if c not in (ids_col, "n_tokens", check_col)]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def run(cols: dict) -> dict:
        coder = _coder(model.value)
        texts = [t or "" for t in cols[text_col].to_pylist()]
        raw = coder.packed_all(texts)
        flat = np.frombuffer(b"".join(raw), np.int32)
        n = np.array([len(x) // 4 for x in raw], np.int32)
        ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat))
        out = {c: cols[c] for c in rest} | {ids_col: ids, "n_tokens": n}
        if check_col:
            out[check_col] = [coder.decode(np.frombuffer(x, np.int32).tolist()) == t for x, t in zip(raw, texts, strict=True)]
        return out

    schema = "".join(f"`{c}` {kinds[c]}, " for c in rest) + f"`{ids_col}` array<int>, n_tokens int" + (f", `{check_col}` boolean" if check_col else "")
    return map_rows(df.select(*rest), schema, run)


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Adds the text of an id list; null for null. Ids outside the vocabulary raise."""
    model = _model(df.sparkSession, model_path)
    rest = [c for c in df.columns if c != text_col]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def run(cols: dict) -> dict:
        coder = _coder(model.value)
        return {c: cols[c] for c in rest} | {text_col: [None if x is None else coder.decode(x) for x in cols[ids_col].to_pylist()]}

    return map_rows(df.select(*rest), ", ".join(f"`{c}` {kinds[c]}" for c in rest) + f", `{text_col}` string", run)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and whether decoding the ids gives the text back, for every row."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, default_model(), check_col="round_trip").select("doc_id", "ids", "n_tokens", "round_trip")
