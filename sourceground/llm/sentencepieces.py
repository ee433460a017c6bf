"""Encoding and decoding with merge-type SentencePiece vocabularies.

A normalised text is a chain of symbols, at first its characters. An agenda holds the
adjacent pairs whose union is a piece, ordered by the piece's score (ties: the left-most
first); the best pair is merged, its new neighbours enter the agenda, and pairs whose
ends have changed meanwhile are passed over. What the vocabulary lacks falls back to
bytes. No merge crosses a place where two letters meet that no piece holds together, such as
the end of a word, so words and their parts are worked on alone and their ids are
remembered in a bounded store.

Every Arrow batch can be checked against the library: it encodes each word that the batch
has worked out and decodes each text's ids; ``agrees`` tells for each row whether the ids
of its words and its decoded text equal the library's. Texts as wholes are held against
the library in tests.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush
from itertools import chain
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
#: Words remembered by a Python worker (twice so many while the older half fades), and letters of the longest of them.
STORE, LONGEST = 1 << 19, 64
#: New words that the library reads together.
TOGETHER = 200
#: UTF-8 bytes of text after which a batch of results is handed on.
FLUSH = 1 << 22


def as_text(word: str) -> str:
    """The text that is normalised to ``word``: without the space mark in front."""
    return word[1:].replace(MARK, " ") if word.startswith(MARK) else word


def plain_normaliser(model: bytes) -> bool:
    """Does the model's normaliser do no more than mark spaces and put one before the text?"""
    try:
        from sentencepiece import sentencepiece_model_pb2
    except ImportError:  # the library then normalises all texts
        return False
    spec = sentencepiece_model_pb2.ModelProto.FromString(model).normalizer_spec
    return not spec.precompiled_charsmap and not spec.normalization_rule_tsv and spec.add_dummy_prefix and spec.escape_whitespaces and not spec.remove_extra_whitespaces


class Vocabulary:
    """Pieces of a merge-type model with their ids, scores and kinds."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = sp.id_to_piece(list(range(len(sp))))
        self.unknown = sp.unk_id()
        self.ids, self.bytes, self.unused, self.written = {}, [None] * 256, set(), []
        for at, name in enumerate(names):
            if sp.is_byte(at):
                self.bytes[int(name[3:5], 16)] = at
                self.written.append(bytes([int(name[3:5], 16)]))
            elif sp.is_control(at) or sp.is_unknown(at):
                self.written.append(b"")
            else:
                self.ids[name] = at
                self.written.append(name.replace(MARK, " ").encode())
                if sp.is_unused(at):
                    self.unused.add(name)
        self.fallback = None not in self.bytes
        within = any(MARK in name.lstrip(MARK) for name in self.ids)
        self.word = re.compile(".+" if within else f"{MARK}+[^{MARK}]*|[^{MARK}]+", re.DOTALL)
        scores = {name: sp.get_score(at) for name, at in self.ids.items()}
        places = {score: place for place, score in enumerate(sorted(set(scores.values()), reverse=True))}
        #: Place of a piece's score among all scores, the highest first.
        self.rank = {name: places[score] for name, score in scores.items()}
        #: Letters that stand together in some piece.
        self.pairs = {name[at : at + 2] for name in self.ids for at in range(len(name) - 1)}
        self.known, self.older, self.fresh = {}, {}, []
        self.plain = plain_normaliser(model)

    def merged(self, word: str) -> list[str]:
        """The symbols that are left when no adjacent pair is a piece."""
        symbols, rank, unused = list(word), self.rank.get, self.unused
        agenda = [(place, left, left + 1, 2) for left, place in enumerate(map(rank, map(add, symbols, symbols[1:]))) if place is not None]
        if not agenda:
            return symbols
        heapify(agenda)
        before, behind = list(range(-1, len(word) - 1)), [*range(1, len(word)), -1]
        parts: dict[str, tuple[str, str]] = {}
        while agenda:
            _, left, right, size = heappop(agenda)
            own, next_ = symbols[left], symbols[right]
            if not own or not next_ or len(own) + len(next_) != size:
                continue  # one of the ends has changed since
            symbols[left] = piece = own + next_
            symbols[right] = ""
            if unused and piece in unused:
                parts[piece] = own, next_
            behind[left] = after = behind[right]
            if after >= 0:
                before[after] = left
                pair = piece + symbols[after]
                if (place := rank(pair)) is not None:
                    heappush(agenda, (place, left, after, len(pair)))
            ahead = before[left]
            if ahead >= 0:
                pair = symbols[ahead] + piece
                if (place := rank(pair)) is not None:
                    heappush(agenda, (place, ahead, left, len(pair)))
        found = [s for s in symbols if s]
        while parts and any(s in parts for s in found):  # pieces that may only be steps on the way
            found = [p for s in found for p in parts.get(s, (s,))]
        return found

    def _ids(self, word: str) -> tuple[int, ...]:
        out: list[int] = []
        for symbol in self.merged(word):
            at = self.ids.get(symbol)
            if at is not None:
                out.append(at)
            elif self.fallback:
                out += [self.bytes[b] for b in symbol.encode()]
            else:
                out.append(self.unknown)
        return tuple(out)

    def _known(self, part: str) -> tuple[int, ...] | None:
        got = self.known.get(part)
        return got if got is not None else self.older.get(part)

    def _keep(self, part: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(part) <= LONGEST:
            if len(self.known) >= STORE:
                self.known, self.older = {}, self.known
            self.known[part] = ids
        return ids

    def _part(self, part: str) -> tuple[int, ...]:
        got = self._known(part)
        return got if got is not None else self._keep(part, self._ids(part))

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of a word; it is cut between letters that no piece holds together, for no merge crosses such a place."""
        got = self._known(word)
        if got is None:
            cuts = [at for at, pair in enumerate(map(add, word, word[1:]), 1) if pair not in self.pairs]
            if cuts:
                got = tuple(chain.from_iterable(self._part(word[i:j]) for i, j in zip([0, *cuts], [*cuts, len(word)], strict=True)))
            else:
                got = self._ids(word)
            self.fresh.append((word, got))
        return self._keep(word, got)

    def differing(self) -> set[str]:
        """Words worked out since the last call whose ids are not the library's; it reads them in groups, and words of groups that differ alone."""
        fresh, self.fresh = self.fresh, []
        groups = [fresh[at : at + TOGETHER] for at in range(0, len(fresh), TOGETHER)]
        theirs = self.library.encode([as_text("".join(word for word, _ in g)) for g in groups], num_threads=1)
        doubtful = [pair for g, their in zip(groups, theirs, strict=True) if list(chain.from_iterable(ids for _, ids in g)) != their for pair in g]
        alone = [self.library.piece_to_id(MARK)]  # a last space mark alone is no text of its own
        theirs = self.library.encode([as_text(word) for word, _ in doubtful], num_threads=1)
        return {word for (word, ids), their in zip(doubtful, theirs, strict=True) if list(ids) != (alone if word == MARK else their)}

    def words(self, text: str) -> list[str]:
        if self.plain:  # a space mark for each space and one before the text
            return self.word.findall(MARK + text.replace(" ", MARK)) if text else []
        return self.word.findall(self.library.normalize(text))

    def encode(self, text: str) -> list[int]:
        return self.joined(self.words(text))

    def joined(self, words: list[str]) -> list[int]:
        known = self.known.get
        ids = list(chain.from_iterable([known(word) or self.encode_word(word) for word in words]))
        if self.fallback or self.unknown not in ids:
            return ids
        return [i for at, i in enumerate(ids) if i != self.unknown or not at or ids[at - 1] != self.unknown]  # a run is one unknown

    def decode(self, ids: list[int]) -> str:
        """The text of ids that ``encode`` made; the space put before the first word goes."""
        text = b"".join(map(self.written.__getitem__, ids)).decode()
        return text[1:] if text.startswith(" ") else text


_loaded: dict[bytes, Vocabulary] = {}


def vocabulary(model: bytes) -> Vocabulary:
    """One vocabulary, with the words that it remembers, for all tasks of a Python worker."""
    if model not in _loaded:
        _loaded.clear()
        _loaded[model] = Vocabulary(model)
    return _loaded[model]


def read_model(path: str) -> bytes:
    """The model file's bytes, read by the driver: a vocabulary is some hundred kilobytes at any size of the data."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: bytes, check: bool = True) -> DataFrame:
    """(doc_id, ids array<int>, decoded, agrees) for every row: the whole text's ids and what they decode to.

    ``model`` is a merge-type model without user-defined pieces. Null texts count as empty
    and have no ids. With ``check`` the library encodes the batch's new words and decodes each
    text's ids as well, and ``agrees`` tells whether both are equal; without it ``agrees`` is
    null. Other columns are not read; rows that repeat are rows like others; an empty table
    gives an empty result.
    """

    def run(batches):
        own, wrong = vocabulary(model), set()

        def handed(doc_ids, texts):
            words = [own.words(t) for t in texts]
            ids = [own.joined(w) for w in words]
            decoded = own.library.decode(ids, num_threads=1)
            agrees = [None] * len(texts)
            if check:
                wrong.update(own.differing())
                agrees = [own.decode(i) == d and (not wrong or wrong.isdisjoint(w)) for i, d, w in zip(ids, decoded, words, strict=True)]
            own.fresh.clear()
            return pa.RecordBatch.from_arrays([doc_ids, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())], names=["doc_id", "ids", "decoded", "agrees"])

        for batch in batches:
            texts, first, held = [], 0, 0
            for at, value in enumerate(batch.column("text")):
                texts.append(value.as_py() or "")
                held += len(texts[-1])
                if held >= FLUSH or at == batch.num_rows - 1:
                    yield handed(batch.column("doc_id").slice(first, len(texts)), texts)
                    texts, first, held = [], at + 1, 0

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_type}, ids array<int>, decoded string, agrees boolean")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """``encoded`` with ``decoded`` made from its column ``ids``."""
    kept = [c for c in encoded.columns if c != "decoded"]

    def run(batches):
        own = vocabulary(model)
        for batch in batches:
            texts = pa.array([own.decode(i or []) for i in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), texts], names=[*kept, "decoded"])

    schema = ", ".join(f"{c} {encoded.schema[c].dataType.simpleString()}" for c in kept)
    return encoded.select(*kept).mapInArrow(run, f"{schema}, decoded string")
