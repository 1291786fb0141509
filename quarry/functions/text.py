"""Text, hash and number expressions. All of them are built-in functions, planned by Catalyst."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: markup that makes a text HTML.
HTML_TAG = r"<\s*/?\s*[a-zA-Z][^>]*>"
#: Service keys that must not show in normalised text.
JSON_MARKERS = (
    "blocks", "api", "styles", "toolbar", "version", "element", "readOnly", "sanitizer", "saver", "selection", "caret",
    "events", "i18n", "inlineToolbar", "listeners", "notifier", "tools", "tooltip", "ui",
)
#: Fixed value: a line that begins a list item.
LIST_MARK = r"^\s*(?:[-*•]|\d+[.)])\s+"

#: The characters that count as white space at the ends of texts.
WHITE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def or_empty(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.btrim(c, F.lit(WHITE))


def strip_chars(c: Column, chars: str) -> Column:
    return F.btrim(c, F.lit(chars))


def normalize_lines(c: Column) -> Column:
    """Lines trimmed, blanks inside them collapsed, at most one empty line in a row, none at the ends."""
    lines = F.transform(F.split(c, r"\R"), lambda x: strip(F.regexp_replace(x, r"[ \t]+", " ")))
    return strip(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"))


def squeeze(c: Column) -> Column:
    """Every run of white space one space; none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def normalize_surface(c: Column) -> Column:
    """The form in which surfaces are compared: one case, one letter for ё, no punctuation around, a space after : ; , and ."""
    low = F.replace(F.lower(squeeze(c)), F.lit("ё"), F.lit("е"))
    bare = F.regexp_replace(low, r"(?U)^[\W_]+|[\W_]+$", "")
    return squeeze(F.regexp_replace(bare, r"(?U)\s*([:;,.])\s*", r"$1 "))


def strip_list_mark(c: Column) -> Column:
    return squeeze(F.regexp_replace(c, r"(?U)^\s*(?:[-*•]|\d+[.)])\s*", ""))


def hash_form(c: Column) -> Column:
    """What content hashes see: LF line ends, no blanks before them, no white space around."""
    unified = F.regexp_replace(or_empty(c), r"\r\n?", "\n")
    return strip(F.regexp_replace(unified, r"[ \t]+\n", "\n"))


def digest(c: Column, length: int) -> Column:
    return F.substring(F.sha2(c, 256), 1, length)


def content_hash(c: Column) -> Column:
    return digest(hash_form(c), 24)


def make_doc_id(source_id: Column, name: Column, hashed: Column) -> Column:
    key = F.coalesce(F.nullif(strip(or_empty(source_id)), F.lit("")), strip(or_empty(name)))
    return F.concat(F.lit("doc_"), digest(F.concat(key, hashed), 20))


def make_block_id(doc_id: Column, order: Column, text: Column) -> Column:
    return F.concat(F.lit("blk_"), digest(F.concat_ws(":", doc_id, order.cast("string"), text), 20))


def json_string(c: Column) -> Column:
    """A JSON string literal; null as null."""
    held = F.to_json(F.array(c))
    return F.coalesce(F.expr("null") if c is None else F.when(c.isNotNull(), F.substring(held, F.lit(2), F.length(held) - 2)), F.lit("null"))


def json_strings(c: Column) -> Column:
    """A JSON array of strings with a space after each comma."""
    return F.concat(F.lit("["), F.array_join(F.transform(c, json_string), ", "), F.lit("]"))


def json_object(**fields: Column) -> Column:
    """JSON text with sorted keys and spaces after colons and commas, of values that are JSON text already."""
    parts = [F.concat(F.lit(f'"{k}": '), fields[k]) for k in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def slugify(c: Column, fallback: str = "item") -> Column:
    bare = F.regexp_replace(F.lower(or_empty(c)), "[^0-9a-zа-яё]+", "-")
    return F.coalesce(F.nullif(strip_chars(bare, "-"), F.lit("")), F.lit(fallback))


def ratio(part: Column, whole: Column) -> Column:
    """min(part / whole, 1) to four places; null of nothing."""
    return F.round(F.least(part / F.nullif(whole, F.lit(0)), F.lit(1.0)), 4)


def is_html(c: Column) -> Column:
    return or_empty(c).rlike(HTML_TAG)


def json_markers(c: Column, keys: tuple[str, ...] = JSON_MARKERS) -> Column:
    """The keys that stand in a text as "key" followed by a colon, in any case."""
    return F.array_compact(F.array(*(F.when(or_empty(c).rlike(f'(?iu)"{k}"\\s*:'), F.lit(k)) for k in keys)))


def source_format(c: Column) -> Column:
    """editorjs_json, html or plain_text of a raw body."""
    body = strip(or_empty(c))
    blocks = F.schema_of_variant(F.try_variant_get(F.try_parse_json(body), "$.blocks", "variant"))
    listed = F.coalesce(blocks.startswith("ARRAY"), F.lit(False))
    broken = F.try_parse_json(body).isNull() & F.substring(body, 1, 4000).rlike(r'(?i)"blocks"\s*:')
    # only what begins as an object is parsed
    editor = F.when(body.startswith("{"), listed | broken).otherwise(False)
    return F.when(editor, F.lit("editorjs_json")).when(is_html(c), F.lit("html")).otherwise(F.lit("plain_text"))


def trim_evidence(c: Column, most: int = 500) -> Column:
    whole = squeeze(or_empty(c))
    return F.when(F.length(whole) <= most, whole).otherwise(F.concat(F.rtrim(F.substring(whole, 1, most)), F.lit("...")))


def any_phrase(normalized: Column, phrases: list[str]) -> Column:
    """Whether a normalised text holds one of the phrases as whole words."""
    wanted = [p for p in phrases if p]
    return normalized.rlike(phrase_pattern(wanted)) if wanted else F.lit(False)


def phrase_pattern(phrases: list[str], flags: str = "U") -> str:
    ordered = sorted(phrases, key=len, reverse=True)
    return rf"(?{flags})(?<!\w)(?:" + "|".join(rf"\Q{p}\E" for p in ordered) + r")(?!\w)"


def occurrences(text: Column, needle: Column) -> Column:
    """How often a non-empty string stands in a text, without overlap."""
    gone = F.length(text) - F.length(F.replace(text, needle))
    return F.when(F.length(needle) > 0, (gone / F.length(needle)).cast("int")).otherwise(0)


def to_int(c: Column, default: int | None = None) -> Column:
    """A cell as a whole number; `default` where it is none. Fractions are cut, as of 3.0 from a table of floats."""
    number = c.cast("string").try_cast("double")
    whole = F.when(F.isnan(number) | (F.abs(number) >= 2.0**63), F.lit(None)).otherwise(number).cast("long")
    return F.coalesce(c.cast("string").try_cast("long"), whole, F.lit(default).cast("long"))


def optional_string(c: Column) -> Column:
    """A cell as text; null where it is empty."""
    return F.nullif(strip(c.cast("string")), F.lit(""))


def string_list(c: Column) -> Column:
    """A cell that holds a JSON array, or one value, as a list of texts that are not empty."""
    listed = F.from_json(c, "array<string>", {"mode": "PERMISSIVE"})
    held = F.when(strip(or_empty(c)).startswith("["), F.coalesce(listed, F.array(c))).otherwise(F.array(c))
    return F.filter(F.transform(held, lambda x: strip(x)), lambda x: x.isNotNull() & (x != ""))


def is_editorjs(c: Column) -> Column:
    return source_format(c) == "editorjs_json"
