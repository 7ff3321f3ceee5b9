"""SentencePiece encoding and decoding with a merge-type (BPE) vocabulary.

Each text gets the dummy prefix, its spaces become U+2581, and it is cut before
each run of U+2581. No piece of the vocabulary has U+2581 after another
character (checked when the model is loaded), so no merge crosses a cut and the
parts can be encoded one by one. A part is encoded with an agenda of adjacent
symbol pairs, ordered by score and then by place, as the merge-type model asks
for; symbols that end outside the vocabulary become byte pieces.

In each Arrow batch the distinct parts that were not met before are encoded and
decoded here and by the sentencepiece library, and compared. Where the two
differ the library's ids are taken and ``n_differ`` counts the part.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from regstar.llm.common import ship, text_of
from regstar.sources.tables import read_table

MODEL = "piece_bpe_32k.model"
SPACE = "\u2581"
PARTS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Parts that a Python worker remembers; more only cost time.
REMEMBERED = 1_200_000
#: Characters of text that are worked on at once.
SLICE_CHARS = 4 << 20


class Vocabulary:
    """Pieces and scores of a merge-type model, and its encoder and decoder."""

    def __init__(self, model: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        s = self.library
        n = s.vocab_size()
        plain = [i for i in range(n) if not (s.is_byte(i) or s.is_control(i) or s.is_unknown(i) or s.is_unused(i))]
        self.ids = {s.id_to_piece(i): i for i in plain}
        self.scores = {s.id_to_piece(i): s.get_score(i) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece has a space after another character: texts can't be cut at spaces")
        if s.encode("a  b ", out_type=str) and "".join(s.encode("a  b ", out_type=str)) != f"{SPACE}a{SPACE}{SPACE}b{SPACE}":
            raise ValueError("the model changes spaces in its normaliser")
        self.bytes = [s.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.names = [str(i) for i in range(n)]
        self.unknown = s.unk_id()
        if any(i == self.unknown for i in self.bytes):
            raise ValueError("the model has no byte pieces")
        self.raw = [b""] * n
        for p, i in self.ids.items():
            self.raw[i] = p.replace(SPACE, " ").encode()
        for b, i in enumerate(self.bytes):
            self.raw[i] = bytes([b])

    def encode(self, part: str) -> list[int]:
        """Ids of one part: the best-scored adjacent pair merges first, ties from the left."""
        symbols = list(part)
        n = len(symbols)
        if n > 1:
            scores = self.scores
            left, right = list(range(-1, n - 1)), list(range(1, n + 1))
            agenda = []
            for i in range(n - 1):
                pair = symbols[i] + symbols[i + 1]
                if pair in scores:
                    agenda.append((-scores[pair], i, pair))
            heapq.heapify(agenda)
            while agenda:
                _, i, pair = heapq.heappop(agenda)
                a = symbols[i]
                j = right[i]
                if a is None or j >= n or len(a) + len(symbols[j]) != len(pair) or a + symbols[j] != pair:
                    continue  # one of the two has merged meanwhile
                symbols[i], symbols[j] = pair, None
                k = right[i] = right[j]
                if k < n:
                    left[k] = i
                    wider = pair + symbols[k]
                    if wider in scores:
                        heapq.heappush(agenda, (-scores[wider], i, wider))
                h = left[i]
                if h >= 0:
                    wider = symbols[h] + pair
                    if wider in scores:
                        heapq.heappush(agenda, (-scores[wider], h, wider))
        out, ids = [], self.ids
        for x in symbols:
            if x is not None:
                if (i := ids.get(x)) is not None:
                    out.append(i)
                else:
                    out.extend(self.bytes[b] for b in x.encode())
        return out

    def same_bytes(self, encoded: list[list[int]], parts: list[str]) -> bool:
        """Whether each part's ids spell exactly its own bytes."""
        raw = self.raw
        spelled = [b"".join([raw[i] for i in ids]) for ids in encoded]
        return spelled == [p.replace(SPACE, " ").encode() for p in parts]

    def decode(self, ids: list[int]) -> str:
        """Text of some ids; a first space, that of the dummy prefix, stays."""
        raw = self.raw
        return b"".join([raw[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(model: str) -> Vocabulary:
    return Vocabulary(model)


class Encoder:
    """Encodes texts part by part, remembering parts across batches."""

    def __init__(self, model: str):
        self.v = vocabulary(model)
        self.known: dict[str, str] = {}  # ids joined by commas
        self.odd: dict[str, str] = {}  # decoded text, of parts that decode to something else than themselves
        self.differ: set[str] = set()

    def learn(self, parts: list[str]) -> None:
        """Encodes and decodes parts here and by the library."""
        lib, v = self.v.library, self.v
        bare = [p[1:].replace(SPACE, " ") for p in parts]  # the library adds the dummy prefix itself
        theirs = lib.encode(bare, num_threads=1)
        texts = lib.decode(theirs, num_threads=1)
        ours = [v.encode(p) for p in parts]
        if SPACE in parts:  # the library gives no ids for the empty text
            theirs[parts.index(SPACE)] = v.encode(SPACE)
        back = [v.decode(ids) for ids in ours] if not v.same_bytes(ours, parts) else [" " + t for t in bare]
        if ours != theirs or [t[1:] for t in back] != texts:
            for k, p in enumerate(parts):
                if ours[k] != theirs[k] or back[k][1:] != texts[k]:
                    self.differ.add(p)
                    ours[k], back[k] = theirs[k], " " + texts[k]
        names = v.names
        for p, ids, text, t in zip(parts, ours, back, bare, strict=True):
            self.known[p] = ",".join([names[i] for i in ids])
            if text[1:] != t:
                self.odd[p] = text

    def texts(self, texts: list[str]) -> Iterator[tuple[int, str, str, int]]:
        """(number of ids, ids joined by commas, decoded text, parts that differ) of each text."""
        cut = [PARTS.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        distinct = set().union(*cut)
        new = distinct.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            for held in (self.known, self.odd, self.differ):
                held.clear()
            new = distinct
        if new:
            self.learn(list(new))
        known, odd, differ = self.known, self.odd, self.differ
        for t, parts in zip(texts, cut, strict=True):
            ids = ",".join([known[p] for p in parts])
            if odd and any(p in odd for p in parts):
                back = "".join([odd.get(p) or p.replace(SPACE, " ") for p in parts])[1:]
            else:
                back = t.replace(SPACE, " ")  # what each part decodes to, without the dummy prefix
            yield ids.count(",") + 1 if parts else 0, ids, back, sum(p in differ for p in parts) if differ else 0


_encoders: dict[str, Encoder] = {}

RESULT = pa.schema([("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.string()),
                    ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("n_differ", pa.int64())])


def encode_texts(docs: DataFrame, model: str | None = None, text_col: str = "text", keep_ids: bool = False,
                 keep_decoded: bool = False) -> DataFrame:
    """Each row as ``row`` with ``tokens``: n_tokens, ids (comma-joined), decoded,
    ids_sha256, decoded_sha256 and n_differ.

    ``ids`` and ``decoded`` are NULL unless asked for. NULL texts count as empty
    and have no ids. Repeated rows get equal results; extra columns of any name
    are carried in ``row``; an empty table has no rows. ``model`` is a file that each executor can read.
    """
    ship(docs.sparkSession)
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path(MODEL)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoders.setdefault(model, Encoder(model))
        for b in batches:
            row, text = b.column(0), b.column(1)
            at = 0
            lengths = pa.compute.utf8_length(text).to_pylist()
            while at < len(lengths):
                end, chars = at, 0
                while end < len(lengths) and (end == at or chars + lengths[end] <= SLICE_CHARS):
                    chars += lengths[end]
                    end += 1
                got = [(n, ids if keep_ids else None, dec if keep_decoded else None, sha(ids), sha(dec), bad)
                       for n, ids, dec, bad in enc.texts(text.slice(at, end - at).to_pylist())]
                tokens = pa.StructArray.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*got, strict=True), RESULT, strict=True)], fields=list(RESULT))
                yield pa.RecordBatch.from_arrays([row.slice(at, end - at), tokens], names=["row", "tokens"])
                at = end

    import pyarrow.compute  # noqa: F401 - loaded for the function above

    base = docs.select(F.struct("*").alias("row"), text_of(text_col).alias("t"))
    kind = base.schema["row"].dataType.simpleString()
    return base.mapInArrow(run, f"row {kind}, tokens struct<n_tokens:bigint,ids:string,decoded:string,"
                           "ids_sha256:string,decoded_sha256:string,n_differ:bigint>")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row per document, and ``n_differ``: parts whose ids the library has otherwise (its ids are then taken)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(docs).select("row.doc_id", "tokens.n_tokens", "tokens.ids_sha256", "tokens.decoded_sha256", "tokens.n_differ")
