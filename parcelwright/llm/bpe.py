"""BPE encoding and decoding through a table of distinct words.

Documents are read in blocks (a partition's consecutive documents, up to ``BLOCK_CHARS`` characters). Pass one splits
each block into words and emits every distinct word of the block once, packed by the word's hash; dealt by that hash,
each distinct word of the whole table is encoded once, and its ids go back to the blocks that hold it. Pass two emits
the block's texts, compressed. Both meet by block, words first: the ids are joined back by position while the texts
stream past, and ids are decoded through the vocabulary's id-to-piece table. What moves is each block's distinct words,
not one row per position; a task holds one block's words.

A text is cut at the vocabulary's special strings, normalised (NFC, white space to one space, lower case) and split by
the vocabulary's pattern. Texts within the Latin blocks are split by a regular expression of our own that equals the
pattern there; for any other text the library's own normaliser and pre-tokenizer find the words.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache, lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 20_000_000
PAYLOAD_CHARS = 2_000_000
#: A task forgets its encoded words beyond so many.
CACHED_WORDS = 1_000_000
_FIELDS = ("block", "kind", "payload", "ids")
_TYPES = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
_SCHEMA = "block long, kind int, payload binary, ids binary"


def _latin() -> str:
    """Characters on which NFC changes nothing and lower case maps one to one: Latin-1 and Latin Extended-A, some punctuation."""
    ranges = ((0x09, 0x0D), (0x20, 0x7E), (0xA1, 0xAC), (0xAE, 0x12F), (0x131, 0x148), (0x14A, 0x17E), (0x2010, 0x2027), (0x2030, 0x203A), (0x20AC, 0x20AC))
    return "".join(chr(c) for a, b in ranges for c in range(a, b + 1))


@cache
def _patterns() -> tuple[re.Pattern[str], re.Pattern[str]]:
    """What is outside the Latin set, and the words within it."""
    chars = _latin()
    of = lambda kind: re.escape("".join(c for c in chars if unicodedata.category(c)[0] == kind))
    letters, numbers = of("L"), of("N")
    return re.compile(f"[^{re.escape(chars)}]"), re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+")


class Vocabulary:
    """A tokenizer file, opened in the process that uses it; ``content`` is the file's text."""

    def __init__(self, content: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(content)
        spec = json.loads(content)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        spec["added_tokens"], spec["normalizer"], spec["post_processor"] = [], None, None
        spec["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        self.word = Tokenizer.from_str(json.dumps(spec))
        self.splitter = self.whole.pre_tokenizer
        self.normalizer = self.whole.normalizer
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.byte_chars = {c: b for b, c in _byte_alphabet().items()}

    def words(self, text: str) -> list[str]:
        """The words of a text in order; a special string is a word that starts with NUL."""
        outside, inside = _patterns()
        found: list[str] = []
        parts = self.cut.split(text) if self.cut and "<|" in text else [text]
        for part in parts:
            if part in self.special and len(parts) > 1:
                found.append("\0" + part)
            elif not outside.search(part):
                found += inside.findall(part.lower())
            else:
                pieces = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(part))
                found += [bytes(self.byte_chars[c] for c in p).decode() for p, _ in pieces]
        return found

    def encode(self, words: list[str]) -> Iterator[str]:
        """The ids of each word, joined by spaces."""
        for word, e in zip(words, self.word.encode_batch(words, add_special_tokens=False), strict=True):
            yield str(self.special[word[1:]]) if word[:1] == "\0" and word[1:] in self.special else " ".join(map(str, e.ids))

    def pieces(self) -> dict[str, str]:
        """The id-to-piece table, ids as text."""
        return {str(i): piece for piece, i in self.whole.get_vocab(with_added_tokens=True).items()}


@lru_cache(maxsize=2)
def vocabulary_of(content: str) -> Vocabulary:
    """A tokenizer file opened once in a process, for all of its tasks."""
    return Vocabulary(content)


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-ins of bytes in byte-level pre-tokenization: printable Latin-1 as it is, the rest from U+0100 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in kept}
    for i, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(0x100 + i)
    return out


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)], names=list(_FIELDS))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int | None, str]]:
    """block, doc_id, text of each document; both passes number the blocks alike."""
    block, size = None, 0
    for batch in batches:
        if block is None and len(batch):
            block = batch.column("part")[0].as_py() << 24
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            text = text or ""
            if size > BLOCK_CHARS:
                block, size = block + 1, 0
            size += len(text)
            yield block, doc_id, text


def _pack(strings: list[str], packer: zstandard.ZstdCompressor) -> bytes:
    """Strings without line ends, which words and ids are."""
    return packer.compress("\n".join(strings).encode("utf-8", "surrogatepass"))


def _unpack(payload: bytes, packer: zstandard.ZstdDecompressor) -> list[str]:
    return packer.decompress(payload).decode("utf-8", "surrogatepass").split("\n")


def _distinct_words(content, parts: int) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(content.value)
        packer = zstandard.ZstdCompressor(level=3)
        current, seen = None, set()

        def flush() -> Iterator[pa.RecordBatch]:
            dealt: dict[int, list[str]] = {}
            for w in sorted(seen):
                dealt.setdefault(zlib.crc32(w.encode("utf-8", "surrogatepass")) % parts, []).append(w)
            if dealt:
                yield pa.RecordBatch.from_pydict({"hash": pa.array(list(dealt), pa.int32()), "block": pa.array([current] * len(dealt), pa.int64()), "words": pa.array([_pack(w, packer) for w in dealt.values()], pa.binary())})

        for block, _, text in _blocks(batches):
            if block != current:
                yield from flush()
                current, seen = block, set()
            seen.update(vocabulary.words(text))
        yield from flush()

    return run


def _encode_words(content) -> object:
    """Packed words in, the same with their ids out; a word is encoded when the task first sees it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(content.value)
        packer, unpacker = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        table: dict[str, str] = {}
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("words").to_pylist(), strict=True):
                words = _unpack(payload, unpacker)
                if len(table) > CACHED_WORDS:
                    table.clear()
                new = [w for w in words if w not in table]
                table.update(zip(new, vocabulary.encode(new), strict=True))
                yield _emit([(block, 0, payload, _pack([table[w] for w in words], packer))])

    return run


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3)
    current, held, size = None, [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            yield _emit([(current, 1, packer.compress(json.dumps(held, ensure_ascii=False).encode("utf-8", "surrogatepass")), None)])

    for block, doc_id, text in _blocks(batches):
        if block != current or size > PAYLOAD_CHARS:
            yield from flush()
            current, held, size = block, [], 0
        held.append((doc_id, text))
        size += len(text)
    yield from flush()


def _join_back(content, keep_text: bool) -> object:
    """Rows sorted by block and kind: first the block's words, then its texts."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if keep_text else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(content.value)
        packer = zstandard.ZstdDecompressor()
        pieces = vocabulary.pieces()
        current, ids = None, {}
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in _FIELDS)
            for block, kind, payload, word_ids in zip(*columns, strict=True):
                if block != current:
                    current, ids = block, {}
                if kind == 0:
                    ids.update(zip(_unpack(payload, packer), _unpack(word_ids, packer), strict=True))
                    continue
                out = []
                for doc_id, text in json.loads(packer.decompress(payload).decode("utf-8", "surrogatepass")):
                    words = vocabulary.words(text)
                    absent = [w for w in set(words) if w not in ids]  # none, unless the two passes saw other blocks (a retry over unordered input)
                    ids.update(zip(absent, vocabulary.encode(absent), strict=True))
                    joined = " ".join(filter(None, map(ids.__getitem__, words)))
                    parts = joined.split()
                    decoded = " ".join(map(pieces.__getitem__, parts))
                    row = (doc_id, len(parts), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
                    out.append((*row, list(map(int, parts)), decoded) if keep_text else row)
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], types[i]) for i in range(len(names))], names=names)

    return run


def encode_documents(docs: DataFrame, tokenizer_json: str, keep_text: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` (with ``ids, decoded`` on request) of every row's whole text.

    ``tokenizer_json`` is the content of a tokenizer file. Null counts as the empty text, which has no tokens; repeated
    rows are encoded alike; an empty table gives an empty result; columns other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(tokenizer_json)
    rows = docs.select("doc_id", "text", F.spark_partition_id().alias("part"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = rows.mapInArrow(_distinct_words(content, 4 * n), "hash int, block long, words binary").repartition(n, "hash").sortWithinPartitions("hash")
    table = words.mapInArrow(_encode_words(content), _SCHEMA)
    both = table.unionByName(rows.mapInArrow(_payloads, _SCHEMA)).repartition(n, "block").sortWithinPartitions("block", "kind")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if keep_text else "")
    return both.mapInArrow(_join_back(content, keep_text), schema)


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """The content of one of the machine's public tokenizer files."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()

