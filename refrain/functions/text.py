"""Column expressions over names, keys and tokens."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

# Results depend on these exact patterns and marks.
NAME_CHAR = "[a-zA-Z0-9]"
FIRST_LISTED = r"(\[)(\w+)(.+)"
IN_PARENTHESES = r"\(([^)]+)"
DIGIT_KEY = "others"
MARKS = {"music": "m", "video": "t"}
AUDIO_EXTENSIONS = ("wav", "mp3")
ALPHABET = "0123456789_abcdefghijklmnopqrstuvwxyz"


def _outside_span(name: Column) -> Column:
    """Name without the span from its first ``(`` to its last ``)``, across lines.

    Two linear substring searches, so a long text full of brackets costs no regex back-tracking.
    """
    before = F.substring_index(name, "(", 1)
    after = F.substring_index(name, ")", -1)
    last_close = F.length(name) - F.length(after)
    has_span = name.contains("(") & name.contains(")") & (last_close > F.instr(name, "("))
    return F.when(has_span, F.concat(before, after)).otherwise(name)


def _pieces(array: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts in runs of about ``size`` bytes: the first row and the one behind the last, their bytes, their ends among these from 0 on.

    UTF-8 bytes of other characters never equal an ASCII one, so ASCII is looked up in a table of bytes.
    """
    texts = array.fill_null("").cast(pa.large_string())
    rows = len(texts)
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + rows + 1]
    content = texts.buffers()[2]
    content = np.frombuffer(content, dtype=np.uint8) if content else np.zeros(0, dtype=np.uint8)
    start = 0
    while start < rows:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + size, side="right")) - 1)
        yield start, stop, content[ends[start] : ends[stop]], ends[start : stop + 1] - ends[start]
        start = stop


def _texts(offsets: list[np.ndarray], content: list[np.ndarray], mask: np.ndarray | None = None) -> pa.Array:
    """Strings of the bytes ``content``, cut at ``offsets``, that begin anew in each run; NULL where ``mask`` is set."""
    shift, ends = 0, [np.zeros(1, np.int64)]
    for own, data in zip(offsets, content):
        ends.append(own[1:] + shift)
        shift += len(data)
    ends = np.concatenate(ends).astype(np.int32)
    data = np.concatenate([np.zeros(0, np.uint8), *content])
    valid = None if mask is None or not mask.any() else pa.py_buffer(np.packbits(~mask, bitorder="little"))
    return pa.Array.from_buffers(pa.string(), len(ends) - 1, [valid, pa.py_buffer(ends), pa.py_buffer(data)])


def clean_name(name: Column) -> Column:
    """Name without its parenthesised span and without anything but ASCII letters and digits, lower-cased.

    Arrow hands over whole batches, whose bytes are looked up in a table; a regular expression that replaces takes
    microseconds for each blank of a text.
    """
    kept = {byte: chr(byte).lower() for byte in range(128) if chr(byte).isalnum()}
    lowered = np.array([ord(kept.get(byte, "\0")) for byte in range(256)], dtype=np.uint8)

    @F.arrow_udf("string")
    def clean(names: pa.Array) -> pa.Array:
        offsets, content = [], []
        for _, _, data, ends in _pieces(names):
            letters = lowered[data]
            is_kept = letters != 0
            offsets.append(np.concatenate([[0], np.cumsum(is_kept)])[ends])
            content.append(letters[is_kept])
        return _texts(offsets, content, names.is_null().to_numpy(zero_copy_only=False))

    return clean(_outside_span(name))


def has_clean_name(name: Column) -> Column:
    """True where ``clean_name`` leaves something; stops at the first letter or digit, so it is cheap to filter on."""
    return _outside_span(name).rlike(NAME_CHAR)


def name_key(name: Column) -> Column:
    """Blocking key: the first character, or one common key for names that start with a digit."""
    first = F.substring(name, 1, 1)
    return F.when(first.rlike("^[0-9]$"), F.lit(DIGIT_KEY)).otherwise(first)


def tagged_id(record_id: Column, source: str) -> Column:
    """Id marked with the catalogue it comes from."""
    return F.concat(F.lit(MARKS[source]), record_id.cast("string"))


def first_listed(listing: Column) -> Column:
    """First element of a bracketed list string, ``''`` where there is none."""
    return F.regexp_extract(listing, FIRST_LISTED, 2)


def tokens(text: Column, mode: str = "char") -> Column:
    """Lower-cased tokens: every word character (``char``) or every run of them (``word``)."""
    pattern = {"char": r"(\w)", "word": r"(\w+)"}[mode]
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1))


def char_counts(text: Column) -> Column:
    """How often each character of ``ALPHABET`` occurs, as an array in the order of ``ALPHABET``.

    Equals counting the ``char`` tokens, but never builds the token array and has a fixed width. Arrow hands
    over whole batches, whose bytes are counted with a few array operations.
    """
    slots = len(ALPHABET)
    slot_of = [ALPHABET.find(chr(byte)) % (slots + 1) for byte in range(256)]

    @F.arrow_udf("array<int>")
    def count(texts: pa.Array) -> pa.Array:
        rows = len(texts)
        table = np.array(slot_of)
        counts = np.zeros((rows, slots + 1), dtype=np.int32)
        for start, stop, data, ends in _pieces(texts):
            place = np.repeat(np.arange(stop - start) * (slots + 1), np.diff(ends))
            place += table[data]
            counts[start:stop] = np.bincount(place, minlength=(stop - start) * (slots + 1)).reshape(-1, slots + 1)
        flat = np.ascontiguousarray(counts[:, :slots]).ravel()
        return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * slots), pa.array(flat))

    return count(F.lower(text))


def label_for(record_id: Column, title: Column) -> Column:
    """Display label: the id in parentheses, then the title."""
    return F.concat(F.lit("("), record_id.cast("string"), F.lit(")"), title)


def id_from_label(label: Column) -> Column:
    """Id between the first ``(`` and the next ``)``."""
    return F.regexp_extract(label, IN_PARENTHESES, 1)


def letter_from_label(label: Column) -> Column:
    """First character behind the first ``)``, lower-cased; NULL where there is none."""
    return F.lower(F.substring(F.get(F.split(label, r"\)", 3), F.lit(1)), 1, 1))


def has_extension(file_name: Column, allowed: tuple[str, ...] = AUDIO_EXTENSIONS) -> Column:
    """True where the last extension, in any case, is one of ``allowed``."""
    return F.lower(F.regexp_extract(file_name, r"\.([^.]*)$", 1)).isin(*allowed)


def path_segment(path: Column, index: int) -> Column:
    """The ``index``-th ``/``-separated segment, counted from 0, NULL past the end."""
    return F.get(F.split(path, "/"), F.lit(index))


def id_from_segment(path: Column, index: int, extension: str) -> Column:
    """Integer in a path segment, read up to ``extension``; NULL where it is no integer."""
    stem = F.substring_index(path_segment(path, index), extension, 1)
    return stem.try_cast("int")
