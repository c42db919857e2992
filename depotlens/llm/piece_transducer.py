"""SentencePiece encoding and decoding as shortest paths of a weighted finite-state transducer.

Three machines are compiled from a model file: the normaliser (a leading space, space -> U+2581), the
pieces with byte fallback (arcs that read characters and write ids), and the order of merges. The last one
is an automaton over pairs of neighbouring pieces: a merge-built segmentation is the only one in which no
merge across any boundary would have come first, so an arc from piece to piece weighs 0 where they may
stand side by side and infinity where not. Composed with an input, the tropical shortest path through the
lattice of (position, last piece) is the encoding.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Distinct parts of words whose shortest paths a task remembers, and pairs of pieces.
REMEMBERED = 400_000
#: A run of spaces with the letters and digits, or with the other signs, that follow it.
PART = re.compile(rf"{SPACE}*[^\W_]+|{SPACE}*(?:[^\w{SPACE}]|_)+|{SPACE}+")


def read_model(path: str = MODEL) -> dict:
    """Pieces with ids and scores, and the 256 byte ids, of a merge-built model with byte fallback.

    Only the normaliser that the file names ``identity`` is compiled; others carry a character map.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, octets = [], [None] * 256
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            octets[int(piece[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces.append((piece, i, model.get_score(i)))
    if None in octets:
        raise ValueError(f"{path} has no byte fallback")
    if model.encode("é ﬁ  ", out_type=str) != model.encode("é", out_type=str) + model.encode(
        "ﬁ  ", out_type=str
    ):
        raise ValueError(f"{path} has a normaliser other than identity")
    runs = {len(p): score for p, _, score in pieces if not p.strip(SPACE) and len(p) > 1}
    shared = len(set(runs.values())) == 1 and len(runs) > 1
    rest = [score for p, _, score in pieces if len(p) > 1 and not (shared and not p.strip(SPACE))]
    if len(set(rest)) != len(rest):
        raise ValueError(f"{path} has merges of equal score other than runs of spaces")
    return {"pieces": pieces, "bytes": octets, "runs": sorted(runs) if shared else []}


class Transducer:
    """The compiled machines; small enough (one entry a piece) to be sent to every task."""

    def __init__(self, model: dict):
        self.ids = {piece: i for piece, i, _ in model["pieces"]}
        ordered = sorted(model["pieces"], key=lambda p: (-p[2], len(p[0]), p[1]))
        self.order = {piece: place for place, (piece, _, _) in enumerate(ordered)}
        self.octets = model["bytes"]
        #: Merges of spaces share a score, so the leftmost goes on growing: each run takes the longest piece that fits.
        self.runs = model["runs"]
        #: Whether a space can follow another character inside a piece; if not, words are separate inputs.
        self.words_apart = not any(SPACE in piece.lstrip(SPACE) for piece in self.ids)
        self.read_back = {i: piece.encode() for piece, i in self.ids.items()}
        self.read_back |= {i: bytes([value]) for value, i in enumerate(self.octets)}
        self.last_merge: dict[str, tuple[str, str] | None] = {}
        for piece, _, _ in ordered:
            self.last_merge[piece] = self._halves(piece)
        #: The piece arcs by character; "" marks the end of a piece, and any single character is one.
        self.trie: dict = {}
        for piece in self.last_merge:
            if self._reachable(piece):
                state = self.trie
                for sign in piece:
                    state = state.setdefault(sign, {})
                state[""] = piece
        for sign in list(self.trie):
            self.trie[sign][""] = sign
        self.pairs: dict[tuple[str, str], bool] = {}
        self.recent: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def __reduce__(self):
        model = [(p, i, -self.order[p]) for p, i in self.ids.items()]
        return Transducer, ({"pieces": model, "bytes": self.octets, "runs": self.runs},)

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """The two parts that the piece's last merge joined, if merging its characters yields the piece."""
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if self._reachable(left) and self._reachable(right) and self._follows(left, right, self.order[piece]):
                return left, right
        return None

    def _reachable(self, piece: str) -> bool:
        return len(piece) == 1 or self.last_merge.get(piece) is not None

    def _follows(self, left: str, right: str, until: float = math.inf) -> bool:
        """Whether no merge across the boundary comes before those that made both sides, nor before ``until``.

        The later of the two merges is undone, time and again. Of equal merges the left one comes first.
        """
        order, limit = self.order, until
        while True:
            if order.get(left + right, math.inf) < limit:
                return False
            a = order[left] if len(left) > 1 else -1
            b = order[right] if len(right) > 1 else -1
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, self.last_merge[left][1]
            else:
                limit, right = b + 1, self.last_merge[right][0]

    def follows(self, left: str, right: str) -> bool:
        """Remembered arcs of the automaton over neighbouring pieces; ``left`` is empty at the start."""
        known = self.pairs.get((left, right))
        if known is None:
            if left and self.runs and not left.strip(SPACE) and not right.strip(SPACE):
                longer = [n for n in self.runs if n > len(left)]
                known = not longer or len(left) + len(right) < longer[0]
            else:
                known = not left or self._follows(left, right)
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def path(self, part: str) -> tuple[bytes, bytes, str, str]:
        """Remembered shortest path of a part: its ids as numbers of 32 bits, what they read as, first and last piece."""
        known = self.recent.get(part)
        if known is None:
            known = self.older.get(part) or self._path(part)
            if len(part) < 64:  # long keys are rare and would fill the memory
                self.recent[part] = known
                if 2 * len(self.recent) >= REMEMBERED:
                    self.older, self.recent = self.recent, {}
        return known

    def _path(self, word: str) -> tuple[bytes, bytes, str, str]:
        """Shortest path through the composition of a normalised input with the machines.

        All finite paths to a position weigh 0 and end in the same piece, as merging has one outcome, so a
        position keeps the first arc found.
        """
        pairs, follows, start = self.pairs, self.follows, self.trie
        ends: list[str | None] = [""] + [None] * len(word)
        for at in range(len(word)):
            before = ends[at]
            if before is None:
                continue
            state, stop = start, at
            for sign in word[at:]:
                state = state.get(sign)
                stop += 1
                if state is None:
                    if stop == at + 1 and follows(before, sign):
                        ends[stop] = sign
                    break
                piece = state.get("")
                if piece is not None and ends[stop] is None:
                    known = pairs.get((before, piece))
                    if known or (known is None and follows(before, piece)):
                        ends[stop] = piece
        at, found = len(word), []
        while at:
            piece = ends[at]
            if piece is None:
                raise ValueError(f"no path through {word[:at]!r}")
            found.append(piece)
            at -= len(piece)
        ids = [i for piece in reversed(found) for i in self._written(piece)]
        return np.array(ids, "<i4").tobytes(), self._read(ids), found[-1], found[0]

    def _written(self, piece: str) -> list[int]:
        known = self.ids.get(piece)
        return [self.octets[b] for b in piece.encode("utf-8", "replace")] if known is None else [known]

    def parts(self, text: str) -> list[tuple[bytes, bytes, str, str]]:
        """Paths of a whole text, part by part.

        Paths of neighbouring parts are one path if the pieces where they meet may stand side by side;
        otherwise the parts are composed as one. No piece reaches over a space into what follows it.
        """
        if not text:
            return []
        line = SPACE + text.replace(" ", SPACE)
        if not self.words_apart:
            return [self._path(line)]
        recent, path, allowed = self.recent.get, self.path, self.pairs.get
        names = PART.findall(line)
        found: list[tuple | None] = [recent(part) or path(part) for part in names]
        # Every text begins with a space, so a part without one has another before it.
        for place in [i for i, part in enumerate(names) if part[0] != SPACE]:
            before = place - 1
            while names[place][0] != SPACE:
                meeting = found[before][3], found[place][2]
                known = allowed(meeting)
                if known or (known is None and self.follows(*meeting)):
                    break
                names[place] = names[before] + names[place]
                found[before], found[place] = None, self._path(names[place])
                while before > 0 and found[before] is None:
                    before -= 1
        return [one for one in found if one]

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text; an empty text has none."""
        return np.frombuffer(b"".join([one[0] for one in self.parts(text)]), "<i4").tolist()

    def both_ways(self, text: str) -> tuple[bytes, str]:
        """Ids of a whole text as little-endian numbers of 32 bits, and the text that these ids decode to."""
        found = self.parts(text)
        return b"".join([one[0] for one in found]), _text(b"".join([one[1] for one in found]))

    def _read(self, ids: list[int]) -> bytes:
        return b"".join(map(self.read_back.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: the machines read backwards; bytes that are no UTF-8 become U+FFFD."""
        return _text(self._read(ids))


def _text(octets: bytes) -> str:
    text = octets.decode("utf-8", "replace").replace(SPACE, " ")
    return text[1:] if text.startswith(" ") else text


def digest(ids: list[int] | np.ndarray | bytes) -> str:
    """SHA-256 of ids as little-endian 32-bit numbers, which may be written so already."""
    return hashlib.sha256(ids if isinstance(ids, bytes) else np.asarray(ids, "<i4").tobytes()).hexdigest()


def _encoder(machine):
    def encode(batches):
        made = machine.value
        for batch in batches:
            flat, counts, shas, backs = [], [], [], []
            for text in batch.column("text").to_pylist():
                if text is None:
                    counts.append(None), shas.append(None), backs.append(None)
                    continue
                octets, back = made.both_ways(text)
                ids = np.frombuffer(octets, "<i4")
                flat.append(ids), counts.append(len(ids)), shas.append(digest(octets))
                backs.append(back == text.replace(SPACE, " "))
            sizes = np.array([n or 0 for n in counts], np.int32)
            bounds = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
            missing = pa.array([n is None for n in counts], pa.bool_())
            lists = pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([np.empty(0, np.int32), *flat])), mask=missing)
            names = [n for n in batch.schema.names if n != "text"]
            arrays = [pa.array(sizes, pa.int64()), lists, pa.array(shas, pa.string()), pa.array(backs, pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), *arrays],
                names=[*names, "n_tokens", "token_ids", "ids_sha256", "round_trip"],
            )

    return encode


def encode_texts(
    spark: SparkSession, docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", model: str = MODEL
) -> DataFrame:
    """Token ids of whole texts, with a check that they decode to the text.

    Returns doc_id, n_tokens, token_ids, ids_sha256 (of the ids as 32-bit numbers) and round_trip. The
    character U+2581 stands for a space in pieces and decodes to one. A null text has 0 tokens and null in
    the other columns, an empty text an empty list. The model file is read by the driver only.
    """
    machine = spark.sparkContext.broadcast(Transducer(read_model(model)))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _encoder(machine),
        f"doc_id {kind}, n_tokens long, token_ids array<int>, ids_sha256 string, round_trip boolean",
    )


def _decoder(machine):
    def decode(batches):
        made = machine.value
        for batch in batches:
            texts = [None if ids is None else made.decode(ids) for ids in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return decode


def decode_ids(spark: SparkSession, encoded: DataFrame, *, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of rows (doc_id, token_ids); null ids give a null text."""
    machine = spark.sparkContext.broadcast(Transducer(read_model(model)))
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "token_ids").mapInArrow(_decoder(machine), f"doc_id {kind}, text string")
