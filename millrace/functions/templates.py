"""Templates of two passes, compiled to expressions (SF6, SF7, SF9).

First $name and ${name} are replaced, unknown names stay and $$ is a dollar; then {name}, {name!r} and {name!s:*>8.3} are, also where the
first pass brought them in, {{ and }} are braces, and an unknown name stands for itself in braces. All values are texts. A template is
read once, when the query is made; only rows whose values bring braces along have their text read again, by the same rules.
"""

from __future__ import annotations

import re
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

DOLLAR = re.compile(r"\$(?:(\$)|([_a-zA-Z][_a-zA-Z0-9]*)|\{([_a-zA-Z][_a-zA-Z0-9]*)\})")
FIELD = re.compile(r"([^{}!:]*)(?:!([rsa]))?(?::([^{}]*))?")
SPEC = re.compile(r"(?:(.)?([<>^]))?(0)?([0-9]+)?(?:\.([0-9]+))?s?", re.DOTALL)
#: What a text is cut into in the second pass: double braces, fields, other text, and braces that are left over.
PARTS = r"\{\{|\}\}|\{[^{}]*\}|[^{}]+|[{}]"


def _escaped(c: Column, ascii_only: bool) -> Column:
    """A text as a quoted literal: controls, and with ascii_only all that is not ASCII, by their numbers."""
    code = F.ascii
    hexed = lambda x, mark, n: F.concat(F.lit(mark), F.lpad(F.lower(F.hex(code(x))), n, "0"))
    single = c.contains("'") & ~c.contains('"')

    def letter(x: Column) -> Column:
        n = code(x)
        other = F.when(n < 0x100, hexed(x, "\\x", 2)).when(n < 0x10000, hexed(x, "\\u", 4)).otherwise(hexed(x, "\\U", 8))
        bad = (n < 32) | n.between(0x7F, 0xA0) | (n == 0xAD)
        if ascii_only:
            bad |= n > 0x7E
        return F.when(x == "\\", "\\\\").when(x == "\n", "\\n").when(x == "\r", "\\r").when(x == "\t", "\\t").when((x == "'") & ~single, "\\'").when(bad, other).otherwise(x)

    quote = F.when(single, '"').otherwise("'")
    return F.concat(quote, F.array_join(F.transform(F.filter(F.split(c, ""), lambda x: x != ""), letter), ""), quote)


def _padded(c: Column, fill: Column, align: Column | str, width: Column) -> Column:
    n = F.length(c)
    left = F.when(F.lit(align) == ">" if isinstance(align, str) else align == ">", width - n).when(F.lit(align) == "^" if isinstance(align, str) else align == "^", F.floor((width - n) / 2).cast("int")).otherwise(0)
    return F.when(n >= width, c).otherwise(F.concat(F.repeat(fill, left), c, F.repeat(fill, width - n - left)))


def _formatted(c: Column, conversion: str | None, spec: str) -> Column:
    """A value by a conversion and a format that are known."""
    m = SPEC.fullmatch(spec)
    if m is None:
        raise ValueError(f"{spec} is no format of a text")
    fill, align, zero, width, precision = m.groups()
    if conversion in ("r", "a"):
        c = _escaped(c, conversion == "a")
    if precision is not None:
        c = F.substring(c, 1, int(precision))
    return _padded(c, F.lit(fill or ("0" if zero else " ")), align or "<", F.lit(int(width))) if width else c


def _fields(text: str) -> list[tuple[str, str | None, str]] | None:
    """The second pass over known text: (literal, None, ...) and (name, conversion, format) as tuples of four; None if braces don't match."""
    out = []
    for part in re.findall(PARTS, text):
        if part in ("{{", "}}"):
            out.append((part[0], False, None, ""))
        elif part in ("{", "}"):
            return None
        elif part[0] == "{":
            m = FIELD.fullmatch(part[1:-1])
            if m is None or not m[1]:
                raise ValueError(f"{part} names no value")
            if re.search(r"[.\[]", m[1]):
                raise ValueError(f"{part}: values have no parts")
            out.append((m[1], True, m[2], m[3] or ""))
        else:
            out.append((part, False, None, ""))
    return out


def _known(parts: list[tuple], values: dict[str, Column]) -> list[Column]:
    return [_formatted(values.get(x, F.lit("{" + x + "}")), conversion, spec) if field else F.lit(x) for x, field, conversion, spec in parts]


def _quoted(x: str, ascii_only: bool) -> str:
    """_escaped of one text."""
    if x.isascii() and x.isprintable() and "'" not in x and "\\" not in x:
        return f"'{x}'"
    quote = '"' if "'" in x and '"' not in x else "'"
    plain = {"\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t"} | ({"'": "\\'"} if quote == "'" else {})

    def letter(c: str) -> str:
        n = ord(c)
        if c in plain:
            return plain[c]
        if not (n < 32 or 0x7F <= n <= 0xA0 or n == 0xAD or ascii_only and n > 0x7E):
            return c
        return f"\\x{n:02x}" if n < 0x100 else f"\\u{n:04x}" if n < 0x10000 else f"\\U{n:08x}"

    return quote + "".join(map(letter, x)) + quote


@lru_cache(4096)
def _field(p: str) -> tuple:
    """Name, conversion, precision, width, fill and alignment of a field."""
    f = FIELD.fullmatch(p[1:-1]) if len(p) > 1 else None
    spec = SPEC.fullmatch(f[3] or "") if f else None
    if spec is None or not f[1] or re.search(r"[.\[]", f[1]):
        raise ValueError(f"{p} is no field")
    fill, align, zero, width, precision = spec.groups()
    return f[1], f[2], None if precision is None else int(precision), int(width or 0), fill or ("0" if zero else " "), align


def second_pass(text: str, values: dict[str, str]) -> str:
    """The second pass over the text of a row; what _fields and _formatted are for known text."""
    out = []
    for p in re.findall(PARTS, text):
        if p in ("{{", "}}"):
            p = p[0]
        elif p[0] in "{}":
            name, conversion, precision, width, fill, align = _field(p)
            p = values.get(name, "{" + name + "}")
            if conversion in ("r", "a"):
                p = _quoted(p, conversion == "a")
            p = p[:precision]
            free = width - len(p)
            if free > 0:
                left = free if align == ">" else free // 2 if align == "^" else 0
                p = fill * left + p + fill * (free - left)
        out.append(p)
    return "".join(out)


def _read_again(text: Column, values: dict[str, Column]) -> Column:
    """The second pass over the texts of rows, by whole Arrow batches, as a pass by expressions is interpreted; null where the text is null."""
    names = list(values)

    @F.arrow_udf("string")
    def again(text: pa.Array, *columns: pa.Array) -> pa.Array:
        rows = zip(*(c.to_pylist() for c in columns), strict=True) if columns else iter(lambda: (), None)
        return pa.array([None if t is None else second_pass(t, dict(zip(names, row, strict=True))) for t, row in zip(text.to_pylist(), rows)], pa.string())

    return again(text, *values.values())


def render(template: str, fields: dict[str, Column]) -> Column:
    """SF6: the template with the columns' texts, in two passes; a null counts as an empty text."""
    values = {k: F.coalesce(c.cast("string"), F.lit("")) for k, c in fields.items()}
    first: list[str | Column] = []  # what the first pass gives: text, and values that it brought in
    last = 0
    for m in DOLLAR.finditer(template):
        first.append(template[last : m.start()])
        name = m[2] or m[3]
        first.append("$" if m[1] else values.get(name, m[0]))
        last = m.end()
    first.append(template[last:])
    # text between values that came in is known; a brace that is open across such a value is only known in the row
    runs: list[list] = [[]]
    for x in first:
        if isinstance(x, str):
            runs[-1].append(x)
        else:
            runs += [x, []]
    known = [r if isinstance(r, Column) else _fields("".join(r)) for r in runs]
    brought = [r for r in runs if isinstance(r, Column)]
    joined = F.concat(*(r if isinstance(r, Column) else F.lit("".join(r)) for r in runs))
    if any(k is None for k in known):
        if not brought:
            raise ValueError(f"a brace of {template} is left over")
        return _read_again(joined, values)
    parts = [c for k in known for c in ([k] if isinstance(k, Column) else _known(k, values))]
    text = F.concat(*parts) if parts else F.lit("")
    if not brought:
        return text
    braces = reduce(lambda a, b: a | b, (r.contains("{") | r.contains("}") for r in brought))
    return F.when(braces, _read_again(F.when(braces, joined), values)).otherwise(text)


def template_file(spark, path: str) -> str:
    """SF7: the text of a template file, without white space around it; one bounded file, read where Spark can."""
    return spark.read.text(path, wholetext=True).first()[0].strip()


def name_context(path: Column) -> dict[str, Column]:
    """SF9: the names that an anchor's image gives to templates; none of them where it has no path."""
    from .scalar import basename, non_blank, stem

    there = non_blank(path)
    return {f"anchor_image_{k}{norm}": f(there) for norm in ("", "_norm") for k, f in (("name", basename), ("stem", stem))}


def prefix_text(template: str | None, context: dict[str, Column], value: str = "", default: str = "ComfyUI") -> Column:
    """SF9: the template's text, else the value, else services_id_task_name, or the one of them that isn't blank, or the default."""
    from .scalar import filename_prefix, non_blank

    text = render(template, context) if template is not None else F.lit(value.strip())
    some = lambda k: context.get(k, F.lit(None)).cast("string")
    return F.coalesce(F.nullif(text, F.lit("")), filename_prefix(non_blank(some("task_name")), non_blank(some("services_id")), default))
