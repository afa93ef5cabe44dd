"""Token ids of whole texts by a public vocabulary file.

The tokenizers library spends about ten microseconds on a word, and words
repeat.  Both kinds of vocabulary start a new token at a single space or line
feed between two printable characters, and at a comma or full stop behind a
letter or digit.  So a text may be cut there: the ids of the pieces, one after
the other, are the ids of the text.  Pieces are looked up in a bounded cache; a
new piece of letters goes straight to the library's BPE model, anything else
through its whole pipeline.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

END_ID = 2

# Cuts at white space are safe only beside characters of this class: printable
# ASCII and the Latin-1 and Latin Extended blocks.
_EDGE = "!-~À-ɏ"
_SAFE = re.compile(f"[{_EDGE}](?:[^ ]*[{_EDGE}])?")
_PIECE = re.compile(f"[ \n,.]?[{_EDGE}](?:[^ ]*[{_EDGE}])?|[,.]")
# Letters (ASCII, Latin-1) behind a space or a line feed.
_WORD = re.compile(r"[ \n][A-Za-zÀ-ÖØ-öø-ÿ]+")
# A comma or full stop that is not behind a letter or digit.
_LOOSE_STOP = re.compile(r"[,.](?<![A-Za-zÀ-ÖØ-öø-ÿ0-9][,.])")
# Words on which the short way is tried before it is used.
_PROBES = ("the", "Word", "QUALITY", "thandertion", "I", "été", "Straße", "ÑANDÚ")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable
    bytes for themselves, the others in order from U+0100."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


class CachedTokenizer:
    """``encode(text)``: the ids as little-endian uint32 bytes (null: empty).

    ``cache_pieces`` bounds each of the cache's two generations: when the young
    one is full it becomes the old one, and pieces still in use move back.  The
    strings of added tokens (special ones, too) become these, as in the library.
    """

    def __init__(self, path: str, cache_pieces: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.added = tuple({t.content for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.cache_pieces = cache_pieces
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.letters = dict(enumerate(_byte_letters()))
        self.line_feed = self.plain("\n")
        self.short = False
        for self.space, self.lower in (("Ġ", False), ("", True)):
            if all(self._model(c + w) == self.plain(c + w) for w in _PROBES for c in " \n"):
                self.short = True
                break

    def plain(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _model(self, piece: str) -> bytes:
        """The ids of letters behind a space or a line feed, by the BPE model."""
        lf, word = piece[0] == "\n", piece[1:]
        if self.lower:
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        ids = array("I", [t.id for t in self.model.tokenize(word if lf else self.space + word)]).tobytes()
        return self.line_feed + ids if lf else ids

    def _keep(self, piece: str, ids: bytes) -> bytes:
        if len(self.young) >= self.cache_pieces:
            self.old, self.young = self.young, {}
        self.young[piece] = ids
        return ids

    def _new(self, piece: str) -> bytes | None:
        """The ids of a piece not in the young cache; None if its edges are not safe."""
        ids = self.old.get(piece)
        if ids is None:
            if self.short and _WORD.fullmatch(piece):
                ids = self._model(piece)
            elif _PIECE.fullmatch(piece):
                ids = self.plain(piece)
            else:
                return None
        return self._keep(piece, ids)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(a in text for a in self.added):             # the library looks for these first
            return self.plain(text)
        cut = text.replace(" ", "\0 ").replace("\n", "\0\n")
        if "\0" not in text and not _LOOSE_STOP.search(text):
            cut = cut.replace(",", "\0,").replace(".", "\0.")
        pieces = cut.split("\0")
        if "\0" in text or _SAFE.fullmatch(pieces[0]) is None:
            return self._unsafe(text)
        ids = list(map(self.young.get, pieces))
        ids[0] = self.plain(pieces[0])
        if None in ids:
            for k, v in enumerate(ids):
                if v is None:
                    ids[k] = v = self._new(pieces[k])
                    if v is None:
                        return self._unsafe(text)
        return b"".join(ids)

    def _unsafe(self, text: str) -> bytes:
        """As ``encode``, cut at spaces only; words at an unsafe space stay together."""
        words = text.split(" ")
        runs, safe = [[words[0]]], _SAFE.fullmatch(words[0]) is not None
        for w in words[1:]:
            ok = _SAFE.fullmatch(w) is not None
            if ok and safe:
                runs.append([w])
            else:
                runs[-1].append(w)
            safe = ok
        out = [self.plain(" ".join(runs[0]))]
        for run in runs[1:]:
            piece = " " + " ".join(run)
            ids = (self.young.get(piece) or self._new(piece)) if len(run) == 1 else None
            out.append(self.plain(piece) if ids is None else ids)
        return b"".join(out)


@lru_cache(maxsize=2)
def worker_tokenizer(name: str) -> CachedTokenizer:
    """One tokenizer a worker process, so its cache serves all tasks that it runs."""
    return CachedTokenizer(tokenizer_path(name))


def tokenizer_path(name: str) -> str:
    """Where a worker finds the vocabulary file; a path is taken as it is."""
    if os.path.sep in name:
        return name
    import public_tokenizers
    return str(public_tokenizers.path(name))
