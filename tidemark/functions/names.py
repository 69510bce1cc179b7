"""Names for tables and columns: transliteration, the 63-byte limit, and permanent allocation without collisions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.spec import RESERVED

LIMIT, HASH = 63, 4

# The transliteration of Cyrillic letters, in the order of the alphabet.
LETTERS = "абвгдеёжзийклмнопрстуфхцчшщъыьэюя"
LATIN = ("a", "b", "v", "g", "d", "e", "yo", "zh", "z", "i", "j", "k", "l", "m", "n", "o", "p", "r", "s", "t", "u", "f", "kh", "ts", "ch", "sh", "sch", "", "y", "", "e", "yu", "ya")

_LATIN_OF = dict(zip(LETTERS, LATIN))
_LATIN_OF |= {a.upper(): b.capitalize() for a, b in _LATIN_OF.items()}
_SINGLE = {a: b for a, b in _LATIN_OF.items() if len(b) == 1}
_OTHERS = {a: b for a, b in _LATIN_OF.items() if len(b) != 1}


def transliterated(c: Column) -> Column:
    """Letter by letter, JVM-side: one ``translate`` for single letters, replacements for the others."""
    one = F.translate(c, "".join(_SINGLE), "".join(_SINGLE.values()))
    return reduce(lambda x, pair: F.replace(x, F.lit(pair[0]), F.lit(pair[1])), _OTHERS.items(), one)


def object_identifier(c: Column) -> Column:
    """A class prefix stays, the rest is transliterated."""
    at = F.instr(c, "_")
    return F.when(at > 0, F.concat(F.substring_index(c, "_", 1), F.lit("_"), transliterated(F.substr(c, at + 1)))).otherwise(transliterated(c))


def byte_prefix(c: Column, most: int) -> Column:
    """The longest prefix of whole characters within so many UTF-8 bytes, without a UDF.

    The bytes are cut, and up to three bytes of a cut last character dropped: the longest valid cut wins.
    """
    raw = c.cast("binary")
    cuts = [F.substring(raw, 1, most - k) for k in range(4)]
    whole = F.coalesce(*[F.when(F.is_valid_utf8(x.cast("string")), x.cast("string")) for x in cuts])
    return F.when(F.octet_length(c) <= most, c).otherwise(whole)


def hashed(mapped: Column, source: Column) -> Column:
    return F.concat(byte_prefix(mapped, LIMIT - HASH - 1), F.lit("_"), F.left(F.md5(source), F.lit(HASH)))


def fitted(mapped: Column) -> Column:
    return F.when(F.octet_length(mapped) <= LIMIT, mapped).otherwise(hashed(mapped, mapped))


def latin(name: str) -> str:
    return "".join(_LATIN_OF.get(ch, ch) for ch in name)


def _suffixed(mapped: str, source: str) -> str:
    head = mapped.encode()[: LIMIT - HASH - 1].decode(errors="ignore")
    return f"{head}_{hashlib.md5(source.encode()).hexdigest()[:HASH]}"


@dataclass
class Names:
    """Permanent allocation of identifiers within scopes; what was once given never changes and is never given again.

    The first free of these wins: the fitted transliteration (hashed at once if it is a service column's name), the
    transliteration with a hash of the source name, then with salted hashes.
    """

    given: dict[tuple[str, str], str] = field(default_factory=dict)
    taken: set[tuple[str, str]] = field(default_factory=set)

    def __post_init__(self):
        self.taken |= {(scope, name) for (scope, _), name in self.given.items()}

    def allocate(self, scope: str, source: str) -> str:
        if (scope, source) not in self.given:
            name = next(n for n in self._candidates(scope, source) if (scope, n) not in self.taken)
            self.given[scope, source] = name
            self.taken.add((scope, name))
        return self.given[scope, source]

    @staticmethod
    def _candidates(scope: str, source: str):
        kind, _, rest = source.partition("_")
        mapped = f"{kind}_{latin(rest)}" if scope == "object" and rest else latin(source)
        reserved = mapped in RESERVED and mapped != source
        yield _suffixed(mapped, mapped) if reserved or len(mapped.encode()) > LIMIT else mapped
        yield _suffixed(mapped, source)
        while True:
            yield _suffixed(mapped, source + uuid4().hex)


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns under their table names; what the mapping doesn't know keeps its own. Two columns of one name are an error."""
    out = [names.get(c, c) for c in df.columns]
    if len(set(out)) < len(out):
        raise ValueError(f"two columns of one name in {out}")
    return df.toDF(*out)


def resolved(name: str, names: dict[str, str]) -> str:
    """The source name that a source or table name stands for; an error if it is neither, or both of different ones."""
    hits = {s for s, t in names.items() if name in (s, t)}
    if len(hits) != 1:
        raise ValueError(f"{name} is {'ambiguous' if hits else 'unknown'}")
    return hits.pop()


class NameBook:
    """Names kept in the store, given by compare and set: of two writers that want one identifier, the second gets another."""

    DOCUMENT = "names"

    def __init__(self, store):
        self.store = store

    def mapping(self, scope: str, sources: Iterable[str]) -> dict[str, str]:
        """Table names of the sources within the scope; new ones are allocated, all at once, and never change."""
        sources = list(sources)
        for _ in range(20):
            revision, held = self.store.document(self.DOCUMENT)
            book = Names({(s, n): t for s, given in held.items() for n, t in given.items()})
            out = {n: book.allocate(scope, n) for n in sources}
            if all(n in held.get(scope, {}) for n in sources):
                return out
            try:
                self.store.replace_document(self.DOCUMENT, revision, held | {scope: held.get(scope, {}) | out})
                return out
            except RuntimeError:  # another writer was first: its names are taken now
                continue
        raise RuntimeError("names change faster than they can be written")
