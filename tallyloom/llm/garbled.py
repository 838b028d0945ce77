"""Text that went through a wrong character encoding: found, and restored where nothing was lost.

For each chain of (right, wrong) encodings the garbled sequence of each character that the chain can
produce is computed beforehand; an automaton finds all of them in one pass, and only the matched spans
are replaced. Where the wrong encoding takes two bytes for a character, sequences depend on their
neighbours: there the automaton knows the inner characters, and the stretch around a hit that converts
back is replaced if it gives Hangul. Sequences that other languages use too (two Latin or kana letters)
count only if the restored syllables are common in the clean names. Where both encodings have one byte
for a letter, a sequence of one letter tells nothing, so whole words are converted back.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYLLABLES = [chr(c) for c in range(0xAC00, 0xD7A4)]
#: Blocks of the other characters whose garbled form is known: Latin with its accents, Greek, Cyrillic, Hebrew,
#: Arabic, Thai, letters of Hangul, Vietnamese, punctuation, signs and symbols, kana, ideographs, wide forms, emoji.
BLOCKS = (
    (0xA0, 0x250), (0x370, 0x530), (0x591, 0x700), (0xE01, 0xE5C), (0x1100, 0x1200), (0x1E00, 0x2000), (0x2010, 0x2060), (0x2070, 0x2800),
    (0x3000, 0x3400), (0x4E00, 0xA000), (0xFF01, 0xFFE7), (0x1F300, 0x1FB00),
)
LETTERS = [chr(c) for a, b in BLOCKS for c in range(a, b)]
#: (right, wrong) encodings; a chain of two is text that was garbled twice.
BYTE_CHAINS = (
    (("utf-8", "latin-1"),), (("utf-8", "cp1252"),), (("utf-8", "cp437"),), (("utf-8", "cp850"),), (("utf-8", "mac_roman"),),
    (("utf-8", "latin-1"), ("utf-8", "latin-1")), (("utf-8", "cp1252"), ("utf-8", "cp1252")), (("utf-8", "latin-1"), ("utf-8", "cp1252")),
    (("cp949", "latin-1"),), (("cp949", "cp1252"),), (("cp949", "cp437"),), (("cp949", "mac_roman"),),
    (("cp949", "latin-1"), ("utf-8", "cp1252")), (("cp949", "cp1252"), ("utf-8", "cp1252")),
)
#: (right, wrong) encodings with one byte for a letter each, for Cyrillic and Greek; letters without case and vowels look like theirs.
NARROW_CHAINS = tuple((right, wrong) for right in ("cp1251", "koi8-r", "iso8859-5", "cp1253", "iso8859-7", "cp866") for wrong in ("cp1252", "latin-1", "mac_roman", "cp437"))
WIDE_CHAINS = (("utf-8", "cp949"), ("utf-8", "cp932"), ("utf-8", "gbk"), ("cp949", "cp932"), ("cp949", "gbk"))
#: Share of the syllables of a doubtful restoration that must be common, and share of all uses that the common ones cover.
COMMON_SHARE, COVERED = 0.6, 0.999
#: The least letters of a word that narrow chains are tried on; no language that writes Latin letters has so many accented ones in a row.
LEAST_WORD = 4
#: Names that can't be garbled: ASCII and Hangul alone, without question marks.
SUSPECT = r"[^\x00-\x7F가-힣]|\?"
_RUN = re.compile(r"[^\x00-\x7f]+")
_MARKS = re.compile(r"\?+")
_VOWELS = frozenset("аеёиоуыэюяіїєαεηιουωάέήίόύώ")
#: What is left of syllables (UTF-8, KS X 1001) in bytes, with ASCII that their last byte took along.
_BYTES = {"utf-8": re.compile(rb"(?:[\xe1-\xef][\x80-\xbf]{2}|[\x20-\x7e])+"), "cp949": re.compile(rb"(?:[\xb0-\xc8][\xa1-\xfe]|[\x20-\x7e])+")}
_ESCAPED = re.compile(r"=\?[^?\s]+\?[BbQq]\?[^?]*\?=")
FOUND = "table_name string, row_id long, name string, restored string, evidence string"


def _decode(data: bytes, charset: str) -> str:
    """Like browsers, bytes that cp1252 leaves undefined stay control characters."""
    if charset == "cp1252":
        return "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in data)
    return data.decode(charset)


def garble(text: str, chain: tuple[tuple[str, str], ...]) -> str:
    for right, wrong in chain:
        text = _decode(text.encode(right), wrong)
    return text


@lru_cache(None)
def _wide_bytes(chain: tuple[str, str]) -> tuple[dict[str, bytes], list[str]]:
    """The bytes behind each character that Hangul turns into where the wrong encoding takes two bytes, and those that make a hit.

    Bytes of one syllable come first, then the last and first bytes of neighbours, then a byte that
    took an ASCII character with it, blanks and punctuation first; a codec's own way back is not always the same.
    """
    right, wrong = chain
    charset = "euc-kr" if right == "cp949" else right
    known = [data for s in SYLLABLES if (data := s.encode(charset, "ignore"))]
    ends, starts = sorted({data[-1] for data in known}), sorted({data[0] for data in known})
    inner = sorted({data[i : i + 2] for data in known for i in range(len(data) - 1)})
    pairs = [*inner, *(bytes([a, b]) for a in ends for b in starts), *(bytes([a, b]) for b in sorted(range(0x20, 0x7F), key=lambda b: chr(b).isalnum()) for a in ends)]
    table: dict[str, bytes] = {}
    hits = []
    for n, pair in enumerate(pairs):
        try:
            text = pair.decode(wrong)
        except UnicodeError:
            continue
        if len(text) == 1:
            table.setdefault(text, pair)
        if n < len(inner) + len(ends) * len(starts):
            hits.append(text)
    return table, hits


@lru_cache(1)
def _automaton():
    import ahocorasick

    by_pattern: dict[str, list[tuple[int, str]]] = defaultdict(list)
    for n, chain in enumerate(BYTE_CHAINS):
        for s in SYLLABLES if chain[0][0] == "cp949" else SYLLABLES + LETTERS:
            try:
                if chain[0][0] == "cp949":
                    s.encode("euc-kr")
                by_pattern[garble(s, chain)].append((n, s))
            except UnicodeError:
                continue
    for chain in WIDE_CHAINS:
        for pattern in _wide_bytes(chain)[1]:
            if (-1, "") not in by_pattern[pattern]:
                by_pattern[pattern].append((-1, ""))
    built = ahocorasick.Automaton()
    for pattern, values in by_pattern.items():
        built.add_word(pattern, (len(pattern), values))
    built.make_automaton()
    return built


def _plausible(text: str, common: frozenset[str]) -> bool:
    letters = [c for c in text if c > "\x7f"]
    hangul = [c for c in letters if "가" <= c <= "힣"]
    if len(hangul) < len(letters) or not hangul:
        return False
    if common:
        return sum(c in common for c in hangul) >= COMMON_SHARE * len(hangul)
    return len(hangul) > 1


def _telling(name: str, start: int, end: int, restored: str, chain: tuple[tuple[str, str], ...]) -> bool:
    """Whether a UTF-8 sequence is one beyond doubt: three characters or more, several letters, or two characters that no language writes so.

    Two characters are doubtful where the first may be a capital letter, or a sign before one. ``Ã`` and
    ``Â`` are never followed by the signs that they are here; others must stand inside a word, with a
    sign behind them.
    """
    if end - start > 2 or len(restored) > 1:
        return True
    first, second = name[start], name[start + 1]
    if chain[0][1] in ("latin-1", "cp1252") and first in "ÃÂ":
        return True
    before, after = name[start - 1 : start], name[end : end + 1]
    sign = second in "ªº" or not second.isalpha()
    return first.isalpha() and sign and (before.islower() or (after.isascii() and after.isalpha()))


def _narrow(run: str, at: int, name: str) -> list[tuple[int, int, str]]:
    """A word of another alphabet out of letters that were read one by one: of one case or with a capital first, and with vowels.

    Of several readings one in small letters comes first, then the one whose share of vowels is most usual.
    """
    around = name[at - 1 : at] + name[at + len(run) : at + len(run) + 1]
    if len(run) < LEAST_WORD or any(c.isascii() and c.isalpha() for c in around):
        return []
    found: list[tuple[bool, float, str]] = []
    for right, wrong in NARROW_CHAINS:
        try:
            text = run.encode(wrong).decode(right)
        except UnicodeError:
            continue
        small = text.lower()
        cased = text in (small, text.upper(), text[:1].upper() + small[1:])
        one = all(c.isalpha() and c > "\u036f" for c in text) and len({c > "\u03ff" for c in text}) == 1
        vowels = sum(c in _VOWELS for c in small)
        if one and cased and 0.2 <= vowels / len(text) <= 0.75:
            found.append((text == text.upper() != small, abs(vowels / len(text) - 0.43), text))
    return [(at, at + len(run), min(found)[2])] if found else []


def _stretches(run: str, right: str, wrong: str, common: frozenset[str]) -> list[tuple[int, int, str]]:
    """The stretches of a run that convert back to Hangul: the whole run, or what of it is whole characters of the right encoding."""
    table = _wide_bytes((right, wrong))[0]
    data, bounds, at = [], {0: 0}, 0
    for n, c in enumerate(run, 1):
        try:
            data.append(table.get(c) or c.encode(wrong))
        except UnicodeError:
            data.append(b"\xff")  # in no sequence
        at += len(data[-1])
        bounds[at] = n
    whole = b"".join(data)
    try:
        text = whole.decode(right)
        return [(0, len(run), text)] if text != run and _plausible(text, common) else []
    except UnicodeError:
        pass
    found = []
    for m in _BYTES[right].finditer(whole):
        start, end, width = m.start(), m.end(), 3 if right == "utf-8" else 2
        while start < end and start not in bounds:
            start += width
        while end > start and end not in bounds:
            end -= 1 if whole[end - 1] < 0x80 else width
        text = whole[start:end].decode(right, "replace")
        if start < end and len(text) > 1 and text != run[bounds[start] : bounds[end]] and _plausible(text, common):
            found.append((bounds[start], bounds[end], text))
    return found


def _spans(run: str, at: int, name: str, common: frozenset[str]) -> list[tuple[int, int, str]]:
    """The garbled spans of a run, as (start, end, restored): those of the chain that explains most of it."""
    matches: dict[int, list[tuple[int, int, str]]] = defaultdict(list)
    wide = False
    for end, (length, values) in _automaton().iter(run):
        for n, s in values:
            if n < 0:
                wide = True
            else:
                matches[n].append((end + 1 - length, end + 1, s))
    best: list[tuple[int, int, str]] = []
    most = (0, 0, 0, 0)  # characters explained, Hangul among the restored, shortness (text garbled twice is explained as such), rank of the chain
    for n, found in matches.items():
        joined: list[list] = []
        for start, end, s in sorted(found, key=lambda m: (m[0], -m[1])):
            if joined and start < joined[-1][1]:
                continue
            if joined and start == joined[-1][1]:
                joined[-1][1], joined[-1][2] = end, joined[-1][2] + s
            else:
                joined.append([start, end, s])
        chain = BYTE_CHAINS[n]
        kept = [(at + a, at + b, s) for a, b, s in joined if (_telling(name, at + a, at + b, s, chain) if chain[0][0] == "utf-8" else _plausible(s, common))]
        worth = (sum(b - a for a, b, _ in kept), sum("가" <= c <= "힣" for _, _, s in kept for c in s), -sum(len(s) for _, _, s in kept), -n)
        if kept and (not best or worth > most):
            best, most = kept, worth
    if wide and not best:
        for right, wrong in WIDE_CHAINS:
            if found := _stretches(run, right, wrong, common):
                return [(at + a, at + b, s) for a, b, s in found]
    return best or _narrow(run, at, name)


def _lost(name: str) -> bool:
    """Whether letters were replaced by question marks, one for each.

    A replacement stands where a word begins, or behind the digits of a word that goes on or is
    followed by another. Behind letters and closing signs a question mark is one, as it is alone in
    brackets or, after a blank, at the end of a sentence.
    """
    for m in _MARKS.finditer(name):
        before, after = name[m.start() - 1 : m.start()], name[m.end() : m.end() + 1]
        alone = len(m.group()) == 1
        if before.isdigit():
            lost = after != "" and after in " _()"
        elif before.isalpha() or (before and before in "?!.=)]}\"'»”’%&"):
            lost = False
        elif alone and before and before in "([{" and after and after in ")]}":
            lost = False
        else:
            lost = not (alone and before == " " and (after == "" or after in ".") and name[max(0, m.start() - 9) : m.start()].rstrip()[-1:].isalpha())
        if lost:
            return True
    return False


def inspect(name: str | None, common: frozenset[str]) -> tuple[str | None, str] | None:
    """(restored name or None, evidence) of a garbled name; None for a clean one.

    Null, empty and ASCII names are clean, as escaped names, other Unicode forms of Hangul and names in
    other languages are. Replacement characters, question marks in place of letters and control
    characters (U+0080 to U+009F) show a loss or an error by themselves; garbled spans beside them are
    restored all the same.
    """
    if not name:
        return None
    pieces, last, spans = [], 0, 0
    for run in _RUN.finditer(name):
        for start, end, text in _spans(run.group(), run.start(), name, common):
            pieces += [name[last:start], text]
            last, spans = end, spans + 1
    whole = "".join(pieces) + name[last:]
    evidence = ["garbled sequence"] * bool(spans)
    if "�" in name or _lost(_ESCAPED.sub("", name)):
        evidence.append("lost characters")
    if re.search(r"[\x80-\x9f]", whole):
        evidence.append("control characters")
    return (whole if spans else None, ", ".join(evidence)) if evidence else None


def common_syllables(names: DataFrame) -> frozenset[str]:
    """The Hangul syllables of the clean names, at most 11,172: the most used ones that together make up ``COVERED`` of all uses."""
    clean = names.filter(r"name rlike '[가-힣]' and not name rlike '[^\\x00-\\x7F가-힣]'")
    each = clean.select(F.explode(F.array_distinct(F.split(F.regexp_replace("name", "[^가-힣]", ""), ""))).alias("c"))
    counts = {r.c: r.n for r in each.filter("c <> ''").groupBy("c").agg(F.count("*").alias("n")).collect()}
    chosen, used, enough = set(), 0, COVERED * sum(counts.values())
    for c, n in sorted(counts.items(), key=lambda e: (-e[1], e[0])):
        if used >= enough:
            break
        chosen.add(c)
        used += n
    return frozenset(chosen)


def find_garbled(names: DataFrame) -> DataFrame:
    """``FOUND``: the garbled names among ``table_name``, ``row_id``, ``name``, each with its restored form or null.

    Repeated rows are reported again; other columns are dropped; empty tables give an empty result.
    """
    common = common_syllables(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for table, row_id, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if found := inspect(name, common):
                    rows.append({"table_name": table, "row_id": row_id, "name": name, "restored": found[0], "evidence": found[1]})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("table_name", pa.string()), ("row_id", pa.int64()), ("name", pa.string()), ("restored", pa.string()), ("evidence", pa.string())]))

    suspects = names.select("table_name", F.col("row_id").cast("long").alias("row_id"), "name").filter(F.col("name").rlike(SUSPECT))
    return suspects.mapInArrow(run, FOUND)
