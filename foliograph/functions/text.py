"""Text expressions: everything is a Column, so it runs inside whole-stage code generation where Spark allows it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Default of :func:`name_from_header`.
NO_NAME = "Unknown Candidate"
#: White space: what ASCII and Unicode count as such, the four separators of ASCII included.
_WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_LINES = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
_MARKER = r"(?m)^\[([A-Z]+)\][ \t]*$"


def strip(c: Column) -> Column:
    """Without white space, Unicode's included, at both ends; only the ends are looked at."""
    return F.btrim(c, F.lit(_WHITE))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def is_blank(c: Column) -> Column:
    return strip(text_or_empty(c)) == ""


def lines(c: Column) -> Column:
    return F.split(c, _LINES)


def compact(items: Column) -> Column:
    """Stripped items without the empty ones."""
    return F.filter(F.transform(items, strip), lambda x: x != "")


def item(cells: Column, i: int) -> Column:
    """Cell i, or the empty string where the row is shorter."""
    return F.coalesce(F.get(cells, F.lit(i)), F.lit(""))


def normalized(c: Column) -> Column:
    """Lower case; runs of other characters than a-z and 0-9 become one space; no space at the ends."""
    return F.trim(F.regexp_replace(F.lower(text_or_empty(c)), "[^a-z0-9]+", " "))


def words(normal: Column) -> Column:
    """Distinct words of a normal form."""
    return F.array_distinct(F.filter(F.split(normal, " "), lambda x: x != ""))


def tokens(c: Column) -> Column:
    """Distinct words of the normal form."""
    return words(normalized(c))


def slug(c: Column) -> Column:
    core = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(core == "", "section").otherwise(core)


def safe_name(c: Column) -> Column:
    """Other characters than letters and digits become one underscore each; none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "_"), "^_+|_+$", "")


def uppercase_ratio(c: Column) -> Column:
    """Share of upper case among the letters; null without letters."""
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]", ""))
    return F.length(F.regexp_replace(c, r"[^\p{Lu}]", "")) / F.nullif(letters, F.lit(0))


def clean_cids(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\s*\(cid:\d+\)", ""))


def without_mailto(c: Column) -> Column:
    return F.regexp_replace(c, "(?i)^mailto:", "")


def header_value(header: Column, label: str) -> Column:
    """What follows the first ``label:`` at a line's start; after an empty value, that is the next line."""
    return strip(F.regexp_extract(header, rf"(?im)^{label}:\s*(.+)$", 1))


def name_from_header(header: Column) -> Column:
    names = F.transform(lines(header), lambda x: strip(F.regexp_replace(strip(x), "^#+", "")))
    return F.coalesce(F.get(F.filter(names, lambda x: (x != "") & ~F.contains(x, F.lit(":"))), F.lit(0)), F.lit(NO_NAME))


def header_of(text: Column) -> Column:
    """What stands before the first section marker."""
    return F.get(F.split(text, _MARKER, 2), F.lit(0))


def section(text: Column, name: str) -> Column:
    """The body of the last section of that name, stripped; empty if there is none."""
    names = F.regexp_extract_all(text, F.lit(_MARKER), F.lit(1))
    bodies = F.slice(F.split(text, _MARKER), F.lit(2), F.greatest(F.size(names), F.lit(0)))
    found = F.filter(F.arrays_zip(names.alias("name"), bodies.alias("body")), lambda s: s["name"] == name)
    return F.coalesce(strip(F.get(found, F.size(found) - 1)["body"]), F.lit(""))


def pipe_rows(body: Column) -> Column:
    """Cells of each line that isn't blank."""
    return F.transform(F.filter(lines(body), lambda x: strip(x) != ""), lambda x: F.transform(F.split(x, r"\|"), strip))


def pairs(body: Column, value: str) -> Column:
    """(name, value) of items separated by semicolons or lines and cut at their first bar."""
    items = F.filter(F.split(body, "[;\n]"), lambda x: strip(x) != "")

    def cut(x: Column) -> Column:
        cells = F.transform(F.split(x, r"\|", 2), strip)
        return F.struct(item(cells, 0).alias("name"), item(cells, 1).alias(value))

    return F.transform(items, cut)


def json_string(c: Column) -> Column:
    """A string as JSON text: quotes, backslashes and control characters escaped, everything else as it is."""
    out = F.regexp_replace(c, r'(["\\])', r"\\$1")
    for plain, letter in (("\n", "n"), ("\r", "r"), ("\t", "t"), ("\b", "b"), ("\f", "f")):
        out = F.replace(out, F.lit(plain), F.lit(f"\\{letter}"))
    rare = out
    for code in (n for n in range(32) if chr(n) not in "\n\r\t\b\f"):
        rare = F.replace(rare, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    return F.concat(F.lit('"'), F.when(F.rlike(out, F.lit("[\\x00-\\x1f]")), rare).otherwise(out), F.lit('"'))


#: How deep lists and objects in a property are written out as such; what lies deeper is written without spaces.
DEPTH = 3


def canonical(value: Column, depth: int = DEPTH) -> Column:
    """JSON text of a Variant: sorted keys, a space after each colon and comma; a missing value is null."""
    kind = F.schema_of_variant(value)
    plain = F.when(kind == "STRING", json_string(F.try_variant_get(value, "$", "string"))).otherwise(F.to_json(value))
    if depth:
        items = F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda x: canonical(x, depth - 1))
        entries = F.array_sort(F.transform(F.map_entries(F.try_variant_get(value, "$", "map<string,variant>")), lambda e: F.struct(e["key"].alias("key"), canonical(e["value"], depth - 1).alias("text"))))
        members = F.transform(entries, lambda e: F.concat(json_string(e["key"]), F.lit(": "), e["text"]))
        array = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
        object_ = F.concat(F.lit("{"), F.array_join(members, ", "), F.lit("}"))
        plain = F.when(F.startswith(kind, F.lit("ARRAY")), array).when(F.startswith(kind, F.lit("OBJECT")), object_).otherwise(plain)
    return F.coalesce(plain, F.lit("null"))


def store_value(value: Column) -> Column:
    """A property as a graph store takes it: scalars and lists of scalars stay, everything nested becomes its JSON text."""
    kind = F.schema_of_variant(value)
    nested = lambda k: F.startswith(k, F.lit("OBJECT")) | F.startswith(k, F.lit("ARRAY"))
    flat = ~F.exists(F.try_variant_get(value, "$", "array<variant>"), lambda x: F.coalesce(nested(F.schema_of_variant(x)), F.lit(False)))
    keep = F.when(F.startswith(kind, F.lit("ARRAY")), flat).otherwise(~F.startswith(kind, F.lit("OBJECT")))
    return F.when(F.coalesce(keep, F.lit(True)), value).otherwise(F.parse_json(json_string(canonical(value))))


def python_list(items: Column) -> Column:
    """JSON text of a list of strings or numbers, with a space after each comma."""
    return F.concat(F.lit("["), F.array_join(F.transform(items, lambda x: json_string(x.cast("string"))), ", "), F.lit("]"))


def python_repr(items: Column) -> Column:
    """A list of strings as Python prints it: single quotes, or double ones around a string with single quotes alone. Line
    feeds, tabs, returns and backslashes are escaped, rarer unprintable characters aren't."""

    def one(x: Column) -> Column:
        x = x.cast("string")
        for plain, letter in (("\\", "\\"), ("\n", "n"), ("\r", "r"), ("\t", "t")):
            x = F.replace(x, F.lit(plain), F.lit(f"\\{letter}"))
        single, double = (F.contains(x, F.lit(q)) for q in ("'", '"'))
        quoted = lambda q, t: F.concat(F.lit(q), t, F.lit(q))
        return F.when(single & ~double, quoted('"', x)).otherwise(quoted("'", F.replace(x, F.lit("'"), F.lit("\\'"))))

    return F.concat(F.lit("["), F.array_join(F.transform(items, one), ", ", "None"), F.lit("]"))


def csv_value(c: Column, kind: str) -> Column:
    """A value as a CSV field: null is empty, a boolean true or false, nested values JSON."""
    if kind.startswith(("array", "map", "struct")):
        return F.coalesce(F.to_json(c), F.lit(""))
    return text_or_empty(c)
