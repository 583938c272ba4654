"""SentencePiece encoding and decoding: exact merge-type encoding by backtracking.

The vocabulary of a BPE model file is read; the encoding is our own.  A sequence of pieces is the merge
result of a text exactly if every adjacent pair is what re-merging the pair's characters gives back.  So
the longest matches of an Aho-Corasick automaton are tried left to right, a piece that does not fit after
its neighbour gives way to its next shorter prefix, and positions from which every attempt failed are
remembered in a bitfield so that none is tried twice.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import arrow_rows, bounded_batches, text_of

SPACE = "▁"
#: Encoded chunks that a worker keeps in each of two generations (about 260 bytes each).
CACHE = 250_000
#: Pairs of pieces whose check a worker remembers (about 200 bytes each).
PAIRS = 500_000
#: Longer chunks are encoded each time they come.
CACHE_CHARS = 40

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Merges:
    """Vocabulary of a BPE model with byte fallback, identity normalisation and a dummy prefix."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto())
        norm, kind = proto.normalizer_spec, pb.ModelProto.SentencePiece
        if proto.trainer_spec.model_type != pb.TrainerSpec.BPE or not proto.trainer_spec.byte_fallback:
            raise ValueError(f"{path}: only BPE models with byte fallback are supported")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError(f"{path}: only the identity normaliser with a dummy prefix is supported")
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in proto.pieces):
            raise ValueError(f"{path}: user-defined or unused pieces are not supported")
        self.bos, self.eos = proto.trainer_spec.bos_id, proto.trainer_spec.eos_id
        self.pieces = [p.piece for p in proto.pieces]
        self.rank = {p.piece: -p.score for p in proto.pieces if p.type == kind.NORMAL}
        ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kind.NORMAL}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kind.BYTE}
        self.surface = [b"" if p.type in (kind.CONTROL, kind.UNKNOWN) else bytes([int(p.piece[3:5], 16)])
                        if p.type == kind.BYTE else p.piece.replace(SPACE, " ").encode() for p in proto.pieces]
        self.unknown = {i for i, p in enumerate(proto.pieces) if p.type == kind.UNKNOWN}
        for i in self.unknown:
            self.surface[i] = proto.trainer_spec.unk_surface.encode()
        self.alphabet = set("".join(ids))
        for c in sorted(self.alphabet - set(ids)):  # characters that only occur inside longer pieces
            ids[c] = len(self.pieces)
            self.pieces.append(c)
        self.length = [len(p) for p in self.pieces]
        self.auto = ahocorasick.Automaton()
        for p, i in ids.items():
            self.auto.add_word(p, i)
        self.auto.make_automaton()
        self.ids, self.fits = ids, {}
        self.shorter = {}
        self.chunks, self.known = self.boundaries(ids), Known(self)

    def boundaries(self, ids: dict[str, int]) -> re.Pattern:
        """Cuts a text only where no piece can lie across, so that chunks can be encoded one by one.

        Cuts lie before a space mark that follows another character, and between a letter and an ASCII
        sign or digit that no piece has after a letter.
        """
        pairs = {pair for p in ids for pair in zip(p, p[1:])}
        if any(b == SPACE != a for a, b in pairs):
            return re.compile(r"(?s).+")
        letter = "[A-Za-z\u00c0-\u024f]"
        after = {b for a, b in pairs if re.match(letter, a)}
        signs = "".join(re.escape(c) for c in map(chr, range(33, 127)) if not c.isalpha() and c not in after)
        line = "" if "\n" in self.alphabet else "\n"
        if not signs:
            return re.compile(f"{SPACE}*[^{SPACE}{line}]+|{SPACE}+|\n+")
        rest = f"[^{signs}{SPACE}{line}]"
        return re.compile(f"{SPACE}*[{signs}]*{rest}+(?:(?<!{letter})[{signs}]+{rest}*)*|{SPACE}*[{signs}]+|{SPACE}+|\n+")

    def merge(self, symbols: list[str]) -> list[str]:
        """Plain merging: always the best-ranked adjacent pair, the leftmost of equals."""
        rank, symbols = self.rank, list(symbols)
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                r = rank.get(symbols[i] + symbols[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def check(self, left: int, piece: int) -> bool:
        """Whether re-merging the two pieces' characters gives the two back (left -1: the piece alone)."""
        one = self.pieces[piece]
        parts = [one] if left < 0 else [self.pieces[left], one]
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        good = self.fits[left, piece] = self.merge(list("".join(parts))) == parts
        return good

    def prefix(self, piece: int) -> int:
        """The longest piece that is a shorter prefix of this one, or -1."""
        text = self.pieces[piece]
        found = self.shorter[piece] = next((self.ids[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.ids), -1)
        return found

    def segment(self, text: str) -> list[int]:
        """Pieces of a text whose characters are all in the alphabet."""
        n = len(text)
        longest = [0] * n
        length, fits, shorter = self.length, self.fits, self.shorter
        for end, piece in self.auto.iter(text):
            longest[end + 1 - length[piece]] = piece  # a later end is a longer match
        ok = bytearray(b"\x01") * (n + 1)  # cleared: nothing from here leads to the end
        out, last, at = [], -1, 0
        piece = longest[0]
        while at < n:
            end = at + length[piece]
            if ok[end]:
                good = fits.get((last, piece))
                if good if good is not None else self.check(last, piece):
                    out.append(piece)
                    last, at = piece, end
                    if at < n:
                        piece = longest[at]
                    continue
            less = shorter.get(piece)
            if less is None:
                less = self.prefix(piece)
            if less >= 0:
                piece = less
                continue
            ok[at] = 0
            if not out:
                raise ValueError(f"no encoding of {text!r}")
            piece = out.pop()
            at -= length[piece]
            last = out[-1] if out else -1
        return out

    def chunk(self, text: str) -> list[int]:
        """Ids of one chunk: segments of known characters, and bytes for all others."""
        ids, known, top, byte = [], self.alphabet, len(self.surface), self.byte
        i, n = 0, len(text)
        while i < n:
            j = n if i == 0 and known.issuperset(text) else i
            while j < n and text[j] in known:
                j += 1
            if j > i:
                for p in self.segment(text[i:j]):
                    if p < top:
                        ids.append(p)
                    else:
                        ids.extend(byte[b] for b in self.pieces[p].encode())
            if j < n:
                ids.extend(byte[b] for b in text[j].encode())
            i = j + 1
        return ids

    def packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, without begin and end."""
        if not text:
            return b""
        return b"".join(map(self.known.__getitem__, self.chunks.findall(SPACE + text.replace(" ", SPACE))))

    def encode(self, text: str, ends: bool = True) -> list[int]:
        body = self.packed(text)
        ids = list(struct.unpack(f"<{len(body) // 4}I", body))
        return [self.bos, *ids, self.eos] if ends else ids

    def decode(self, ids) -> str:
        """Text of ids: control ids vanish, one leading space goes, bytes that are no UTF-8 become U+FFFD each."""
        ids = [i for i in ids]
        while ids and not self.surface[ids[0]]:
            del ids[0]
        while ids and not self.surface[ids[-1]]:
            del ids[-1]
        if self.bos in ids or self.eos in ids:  # a control id ends a run of bytes
            runs = [list(g) for full, g in groupby(ids, lambda i: bool(self.surface[i])) if full]
        else:
            runs = [ids]
        out = "".join(b"".join([self.surface[i] for i in run]).decode("utf-8", "each_byte") for run in runs)
        return out[1:] if ids and out[:1] == " " and self.pieces[ids[0]][:1] == SPACE else out


class Known(dict):
    """Encoded chunks in two generations of bounded size: a full one becomes the old one."""

    def __init__(self, model: Merges):
        super().__init__()
        self.model, self.old = model, {}

    def __missing__(self, chunk: str) -> bytes:
        got = self.old.get(chunk)
        if got is None:
            ids = self.model.chunk(chunk)
            got = struct.pack(f"<{len(ids)}I", *ids)
        if len(chunk) <= CACHE_CHARS:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[chunk] = got
        return got


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def encode_decode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text",
                  keep_ids: bool = True) -> DataFrame:
    """Encode whole texts with begin and end ids, then decode them again.

    Returns ``key, n_tokens, ids (array<int>, if keep_ids), ids_sha256, decoded_sha256, round_trip``.
    Null text counts as empty and gives the two end ids; the input's other columns are ignored; repeated
    rows give repeated results; an empty table gives none.  ``model_path`` must be readable on executors.
    """
    bounded_batches(docs.sparkSession)
    fields = [pa.field(key, pa.int64()), pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()),
              pa.field("decoded_sha256", pa.string()), pa.field("round_trip", pa.bool_())]
    if keep_ids:
        fields.append(pa.field("ids", pa.list_(pa.int32())))
    schema = pa.schema(fields)
    ddl = f"`{key}` long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merges(model_path)
        begin, end = struct.pack("<I", m.bos), struct.pack("<I", m.eos)
        for b in arrow_rows(batches):
            rows = [[] for _ in fields]
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = begin + m.packed(t) + end
                ids = struct.unpack(f"<{len(raw) // 4}I", raw)
                back = m.decode(ids)
                for col, v in zip(rows, (k, len(ids), hashlib.sha256(raw).hexdigest(),
                                         hashlib.sha256(back.encode()).hexdigest(), back == t.replace(SPACE, " "), ids)):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(rows, fields)], schema=schema)

    return docs.select(F.col(key).cast("long").alias(key), text_of(text).alias("text")).mapInArrow(run, ddl)
