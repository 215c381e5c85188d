"""Personal data and secrets replaced by keyed surrogates of the same type and form.

1. Every text is searched for e-mail addresses, phone, card and account numbers, IP addresses, social
   security numbers, keys and tokens, and names after a title; then for those names without one.
2. A surrogate is a keyed hash of the type and the canonical form of what was found, so it is the same
   wherever that occurs and however it is written, and nobody without the key can go back.
   It has the same letters-and-digits pattern; names keep script, gender and letter case; valid check
   digits stay valid, private addresses private.
3. The distinct finds are checked as a table: a surrogate that two finds share, or that is itself found
   somewhere, is drawn anew for all but one of them. What is open after some rounds (but names, which grow) is
   ranked within its form and takes the free values of the form in the order of a keyed permutation; what a
   full form has no value for takes one of a wider form (``_slots``), until none is left.
4. Texts are rewritten in place. Only finds that were drawn anew have to be joined to their documents.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.operators.numbering import running_total
from ledgermill.session import stored

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Found by their digits; an earlier kind wins.
NUMBERS = re.compile(
    rf"(?<![\w.])(?P<ip>{OCTET}(?:\.{OCTET}){{3}})(?![\w]|\.\d)"
    r"|(?<![\w-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    r"|(?<![\w-])(?P<card>\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])"
    r"|(?<![\w+])(?P<phone>\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}|\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}|\d{3}-\d{4})(?![\w-]|\.\d)"
)
SECRET = re.compile(
    r"(?<![0-9A-Za-z])(?:(?P<hex>[0-9a-f]{32,128}|[0-9A-F]{32,128})"
    r"|(?P<key>AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,}|xox[baprs]-[A-Za-z0-9-]{10,})"
    r"|(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?))(?![0-9A-Za-z])"
)
LOCAL = re.compile(r"[\w.%+-]+\Z")
DOMAIN = re.compile(r"[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")
#: Titles before names, by gender.
TITLES = {
    "m": ["Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Господин", "г-н", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "Госпожа", "г-жа", "Κυρία"],
    "x": ["Dr", "Prof", "Доктор"],
}
GENDER = {title: gender for gender, titles in TITLES.items() for title in titles}
UPPER = "A-ZÀ-ÖØ-ÞĀ-ŽΑ-ΫА-ЯЁ"
TITLED = re.compile(rf"(?<!\w)(?P<title>{'|'.join(sorted(GENDER, key=len, reverse=True))})\.? (?P<name>[{UPPER}][\w'’-]+(?: [{UPPER}][\w'’-]+){{0,2}})")
#: Words that begin sentences or follow a title without being a name.
NO_NAMES = frozenset(
    "the an and or but if in on at by of to for from with as is was are were be has had he she it we they you his her its our their this that these those then there who what when where why how not no yes der die das und ein eine er sie es wir ihr im in am le la les un une et il elle el los las una y en de".split()
)
#: Syllables of invented names, and their endings by gender.
SYLLABLES = {
    "latin": ("b c d f g h j k l m n p r s t v w z".split(), "a e i o u".split(), {"m": "n r s k t".split(), "f": ["a"], "x": "e i o".split()}),
    "cyrillic": ("б в г д ж з к л м н п р с т ф х".split(), "а е и о у".split(), {"m": "н р в к т".split(), "f": ["а"], "x": "е и о".split()}),
    "greek": ("β γ δ ζ θ κ λ μ ν π ρ σ τ φ χ".split(), "α ε ι ο υ".split(), {"m": ["ς"], "f": ["α"], "x": "ε ι ο".split()}),
}
KEYS = ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "xoxb-", "xoxa-", "xoxp-", "xoxr-", "xoxs-")
DIGIT, LETTER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"
#: Rounds of random draws; consecutive values of a form that are made at once, and least of them that are looked at.
ROUNDS, CHUNK, LEAST = 3, 4096, 65_536


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of what is found, in order and without overlap."""
    out = []
    at = text.find("@")
    while at >= 0:
        left, right = LOCAL.search(text, max(0, at - 64), at), DOMAIN.match(text, at + 1, at + 256)
        if left and right:
            # A sentence's full stop before the address does not belong to it.
            start = left.start() + len(left.group()) - len(left.group().lstrip(".%+-"))
            if start < at:
                out.append((start, right.end(), "email", text[start : right.end()].lower()))
        at = text.find("@", at + 1)
    for m in NUMBERS.finditer(text):
        kind, value = m.lastgroup, m.group()
        digits = "".join(c for c in value if c.isdigit())
        if kind == "phone" and value[0] == "+":
            kind = f"phone{len(re.match(r'[+][0-9]+', value).group()) - 1 if not value[1:].isdigit() else 1}"
        out.append((m.start(), m.end(), kind, value if kind == "ip" else digits))
    for m in SECRET.finditer(text):
        value = m.group()
        if any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
            out.append((m.start(), m.end(), m.lastgroup, re.sub(r"[ ]", "", value) if m.lastgroup == "iban" else value.lower() if m.lastgroup == "hex" else value))
    named: dict[str, str] = {}
    for m in TITLED.finditer(text):
        parts = list(re.finditer(r"\S+", m.group("name")))
        gender = GENDER[m.group("title")]
        for i, part in enumerate(parts):
            name = re.sub(r"['’][sS]\Z", "", part.group().rstrip("'’-"))
            start = m.start("name") + part.start()
            role = "surname" if i == len(parts) - 1 else f"forename-{gender}"
            out.append((start, start + len(name), f"{role}-{_script(name)}", name.lower()))
            named.setdefault(name.lower(), out[-1][2])
    # The same names elsewhere in the text, without a title; words of a sentence are no names there.
    again = sorted(named.keys() - NO_NAMES, key=len, reverse=True)
    if again:
        for m in re.finditer(rf"(?<!\w)(?:{'|'.join(map(re.escape, again))})(?!\w)", text, re.IGNORECASE):
            if m.group()[0].isupper() and m.group().lower() in named:
                out.append((m.start(), m.end(), named[m.group().lower()], m.group().lower()))
    out.sort(key=lambda x: (x[0], -x[1]))
    kept, reach = [], 0
    for x in out:
        if x[0] >= reach:
            kept.append(x)
            reach = x[1]
    return kept


def _script(name: str) -> str:
    c = name[0].lower()
    return "cyrillic" if "а" <= c <= "ё" else "greek" if "α" <= c <= "ω" or c in "άέήίόύώ" else "latin"


class _Draw:
    """A stream of choices that the key, the kind, the canonical form and the attempt decide."""

    def __init__(self, key: bytes, *parts: str):
        text = "\x1f".join(parts).encode()
        self.bits = int.from_bytes(b"".join(hashlib.blake2b(text, key=key, salt=bytes([i] * 16)).digest() for i in range(4)), "big")

    def of(self, choices):
        self.bits, i = divmod(self.bits, len(choices))
        return choices[i]


def _pattern(draw: _Draw, text: str) -> str:
    return "".join(
        draw.of(DIGIT) if c.isdigit() else draw.of(LETTER) if c.islower() else draw.of(LETTER.upper()) if c.isupper() else c for c in text
    )


def _luhn(digits: str) -> bool:
    twice = (2 * int(c) for c in digits[-2::-2])
    return (sum(int(c) for c in digits[::-2]) + sum(d - 9 * (d > 9) for d in twice)) % 10 == 0


def surrogate(key: bytes, kind: str, canon: str, attempt: int) -> str:
    """The canonical form of the surrogate; of the same length, but for names."""
    draw = _Draw(key, kind, canon, str(attempt))
    if kind == "email":
        local, domain = canon.rsplit("@", 1)
        labels = domain.split(".")
        # A domain has one surrogate, whoever's address it is in.
        own = _Draw(key, "domain", domain)
        return _pattern(draw, local) + "@" + ".".join([_pattern(own, x) for x in labels[:-1]] + labels[-1:])
    if kind == "ip":
        a, b = canon.split(".")[:2]
        private = [a] if a in ("10", "127") else [a, b] if (a, b) == ("192", "168") or (a == "172" and 16 <= int(b) < 32) else []
        first = [n for n in range(1, 224) if n not in (10, 127, 172, 192)]
        drawn = [str(draw.of(first))] + [str(draw.of(range(1, 255))) for _ in range(3)]
        return ".".join(private + drawn[len(private) :])
    if kind == "card":
        body = canon[0] + _pattern(draw, canon[1:-1])
        check = next(c for c in DIGIT if _luhn(body + c))
        return body + (check if _luhn(canon) else draw.of([c for c in DIGIT if c != check]))
    if kind.startswith("phone"):
        n = int(kind[5:] or 0)
        return canon[:n] + _pattern(draw, canon[n:])
    if kind == "hex":
        return "".join(draw.of(HEX) for _ in canon)
    if kind == "key":
        n = next(len(p) for p in KEYS if canon.startswith(p))
        return canon[:n] + _pattern(draw, canon[n:])
    if kind == "iban":
        bank = _pattern(draw, canon[4:])
        return _iban(canon[:2], bank)
    if "name-" in kind:
        consonants, vowels, endings = SYLLABLES[kind.rsplit("-", 1)[1]]
        gender = kind.split("-")[1] if kind.startswith("forename") else "x"
        stem = "".join(draw.of(consonants) + draw.of(vowels) for _ in range(2 + draw.of((0, 1)) + attempt // 4))
        return stem + (draw.of(consonants) if gender != "m" else "") + draw.of(endings[gender])
    return _pattern(draw, canon)


def _slots(key: bytes, kind: str, canon: str, width: int) -> tuple[list, str]:
    """Choices for each piece of a surrogate of ``canon``, and what check digits follow.

    A wider form has ``width`` more letters in an address's local part, or more digits (letters after a
    letter) at its end. Private IP addresses go on to 172.16-31, then all to 10, then to the reserved 240-255,
    then to more numbers.
    """
    kinds = lambda text: [DIGIT if c.isdigit() else LETTER if c.islower() else LETTER.upper() if c.isupper() else [c] for c in text]
    if kind == "ip":
        a, b = canon.split(".")[:2]
        octet = [f".{n}" for n in range(1, 255)]
        if width == 0:
            first = [str(n) for n in range(1, 224) if n not in (10, 127, 172, 192)]
            private = [[a]] if a in ("10", "127") else [[a], ["." + b]] if (a, b) == ("192", "168") or (a == "172" and 16 <= int(b) < 32) else [first]
            return private + [octet] * (4 - len(private)), ""
        if width == 1 and a in ("172", "192"):
            return [["172"], [f".{n}" for n in range(16, 32)], octet, octet], ""
        return [["10"] if width <= 2 else [str(n) for n in range(240, 256)]] + [octet] * max(3, width), ""
    if kind == "email":
        local = canon.rsplit("@", 1)[0]
        domain = surrogate(key, kind, canon, 0).rsplit("@", 1)[1]
        return kinds(local) + [LETTER] * width + [["@" + domain]], ""
    if kind == "card":
        valid = _luhn(canon)
        return [[canon[0]]] + [DIGIT] * (len(canon) - 2 + width) + ([] if valid else [DIGIT[:9]]), "valid" if valid else "invalid"
    if kind == "iban":
        return kinds(canon[4:]) + [DIGIT] * width, canon[:2]
    if kind == "hex":
        return [HEX] * (len(canon) + width), ""
    fixed = next(len(p) for p in KEYS if canon.startswith(p)) if kind == "key" else int(kind[5:] or 0) if kind.startswith("phone") else 0
    more = LETTER if canon[-1].islower() else LETTER.upper() if canon[-1].isupper() else DIGIT
    return [[canon[:fixed]]] + kinds(canon[fixed:]) + [more] * width, ""


def form(key: bytes, kind: str, canon: str, width: int) -> tuple[str, int]:
    """A name that the finds share whose surrogates come from the same values, and how many there are."""
    slots, check = _slots(key, kind, canon, width)
    pieces = [f"{len(s)}{s[0]}" for s in slots]
    return "\x1f".join([kind, check, *pieces]), math.prod(map(len, slots))


def _permuted(key: bytes, name: str, size: int, i: int) -> int:
    """Number ``i`` of a keyed order of range(size): a Feistel network, walked until it is within."""
    half = max(1, (size - 1).bit_length() + 1 >> 1)
    mask = (1 << half) - 1
    while True:
        left, right = i >> half, i & mask
        for r in range(6):
            mixed = hashlib.blake2b(f"{name}\x1f{r}\x1f{right}".encode(), key=key, digest_size=(half + 7) // 8, salt=b"order").digest()
            left, right = right, left ^ (int.from_bytes(mixed, "big") & mask)
        i = left << half | right
        if i < size:
            return i


def values_at(key: bytes, kind: str, canon: str, width: int, places: range) -> list[str]:
    """Surrogates with these numbers of a find's form."""
    slots, check = _slots(key, kind, canon, width)
    name, size = form(key, kind, canon, width)
    out = []
    for i in places:
        i = _permuted(key, name, size, i)
        pieces = []
        for choices in slots:
            i, k = divmod(i, len(choices))
            pieces.append(choices[k])
        if kind == "card":
            body = "".join(pieces) if check == "valid" else "".join(pieces[:-1])
            right = next(c for c in DIGIT if _luhn(body + c))
            out.append(body + (right if check == "valid" else [c for c in DIGIT if c != right][int(pieces[-1])]))
        else:
            out.append(_iban(check, "".join(pieces)) if kind == "iban" else "".join(pieces))
    return out


def _iban(country: str, bank: str) -> str:
    value = int("".join(str(int(c, 36)) for c in bank + country + "00"))
    return country + f"{98 - value % 97:02d}" + bank


def render(original: str, kind: str, value: str) -> str:
    """The surrogate in the way the original is written."""
    if "name-" in kind:
        return value.upper() if original.isupper() and len(original) > 1 else value.capitalize()
    if kind == "ip":
        return value
    if kind == "hex":
        return value.upper() if original.upper() == original else value
    if kind == "email" and sum(map(str.isalnum, value)) != sum(map(str.isalnum, original)):
        return value.upper() if original.isupper() else value  # of a wider form
    letters = iter(c for c in value if c.isalnum())
    out = []
    for c in original:
        if c.isalnum():
            d = next(letters)
            out.append(d.upper() if c.isupper() else d)
        else:
            out.append(c)
    return "".join([*out, *letters])


def _finds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        k1, k2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
        for i, text in enumerate(batch.column("text")):
            rows += {(k1[i], k2[i], kind, canon) for _, _, kind, canon in find(text.as_py())}
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["k1", "k2", "kind", "canon"])


def _drawn(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = [surrogate(key, *r.values()) for r in batch.select(["kind", "canon", "attempt"]).to_pylist()]
            yield batch.append_column("value", pa.array(value, pa.string()))

    return run


def attempts(finds: DataFrame, key: bytes) -> DataFrame:
    """kind, canon, attempt, value for each distinct find, no value twice and none that is a find itself."""
    distinct = stored(finds.select("kind", "canon").distinct())
    real = distinct.select("kind", F.col("canon").alias("value"))
    todo, settled, attempt = distinct, None, 0
    while True:
        # Names grow with each attempt, so they never run out.
        drawn = stored(todo.withColumn("attempt", F.lit(attempt)).mapInArrow(_drawn(key), "kind string, canon string, attempt int, value string"))
        taken = real if settled is None else real.union(settled.select("kind", "value"))
        first = drawn.groupBy("kind", "value").agg(F.min("canon").alias("canon"))
        free = first.join(taken, ["kind", "value"], "left_anti")
        fine = stored(drawn.join(free, ["kind", "value", "canon"], "left_semi").select("kind", "canon", "attempt", "value"))
        settled = fine if settled is None else settled.union(fine)
        todo = drawn.join(fine, ["kind", "canon"], "left_anti").select("kind", "canon")
        attempt += 1
        if attempt == ROUNDS:
            left = stored(todo)
            todo, rest = left.filter(F.col("kind").contains("name-")), left.filter(~F.col("kind").contains("name-"))
            settled = settled.union(placed(rest, real, settled, key))
        todo = stored(todo)
        if todo.isEmpty():
            return settled


def placed(todo: DataFrame, real: DataFrame, settled: DataFrame, key: bytes) -> DataFrame:
    """kind, canon, attempt, value for finds that no draw has settled: free values of their forms in keyed order."""
    todo, attempt, out = stored(todo.withColumn("width", F.lit(0)).withColumn("step", F.lit(0))), ROUNDS, settled.limit(0)
    while not todo.isEmpty():
        formed = stored(todo.mapInArrow(_forms(key), "kind string, canon string, width int, step int, form string, size long"))
        # Each step looks at four times as many of the form's values, from its first one.
        upto = F.least(F.col("size").cast("double"), F.col("n") * F.pow(F.lit(4.0), F.col("step") + 1) + LEAST).cast("long")
        groups = formed.groupBy("form").agg(
            F.count(F.lit(1)).alias("n"), F.max("step").alias("step"), F.min("size").alias("size"), F.min(F.struct("kind", "canon", "width")).alias("of")
        )
        groups = stored(groups.select("form", "size", "of.*", upto.alias("upto")))
        chunks = groups.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("upto") - 1, F.lit(CHUNK).cast("long"))))
        chunks = chunks.repartition("form", "start").select("form", "kind", "canon", "width", "start", F.least(F.col("start") + CHUNK, "upto").alias("stop"))
        values = stored(chunks.mapInArrow(_values(key), "form string, kind string, nth long, value string"))
        taken = real.union(settled.select("kind", "value")).union(out.select("kind", "value"))
        free = values.join(taken, ["kind", "value"], "left_anti").withColumn("one", F.lit(1).cast("long"))
        free = running_total(free, ["form"], [F.col("nth")], "one", "rank").select("form", "rank", "value")
        ranked = running_total(formed.withColumn("one", F.lit(1).cast("long")), ["form"], [F.col("canon")], "one", "rank")
        found = ranked.join(free, ["form", "rank"], "left").join(groups.select("form", "upto"), "form")
        found = stored(found.select("kind", "canon", "width", "step", "size", "upto", "value"))
        out = out.union(found.filter("value is not null").select("kind", "canon", F.lit(attempt).alias("attempt"), "value"))
        full = F.col("upto") >= F.col("size")
        todo = stored(
            found.filter("value is null").select(
                "kind", "canon", (F.col("width") + full.cast("int")).alias("width"), F.when(full, 0).otherwise(F.col("step") + 1).alias("step")
            )
        )
        attempt += 1
    return out


def _forms(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [form(key, *r.values()) for r in batch.select(["kind", "canon", "width"]).to_pylist()]
            batch = batch.append_column("form", pa.array([f[0] for f in found], pa.string()))
            yield batch.append_column("size", pa.array([min(f[1], 1 << 62) for f in found], pa.int64()))

    return run


def _values(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():  # at most CHUNK values each
                nth = range(r["start"], r["stop"])
                value = values_at(key, r["kind"], r["canon"], r["width"], nth)
                columns = [pa.array([r["form"]] * len(nth)), pa.array([r["kind"]] * len(nth)), pa.array(nth, pa.int64()), pa.array(value, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["form", "kind", "nth", "value"])

    return run


def _rewritten(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, kinds = [], []
            again = batch.column("again").to_pylist()
            for i, text in enumerate(batch.column("text")):
                text = text.as_py()
                settled = {(r["kind"], r["canon"]): r["value"] for r in again[i] or ()}
                parts, at, seen = [], 0, []
                for start, end, kind, canon in find(text):
                    value = settled.get((kind, canon)) or surrogate(key, kind, canon, 0)
                    parts += [text[at:start], render(text[start:end], kind, value)]
                    seen.append(re.match("[a-z]+", kind).group())
                    at = end
                left.append("".join([*parts, text[at:]]))
                kinds.append(seen)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(left, pa.string()), pa.array([len(k) for k in kinds], pa.int64()), pa.array(kinds, pa.list_(pa.string()))],
                ["doc", "text", "n_replaced", "kinds"],
            )

    return run


def replace_personal_data(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc``, ``text`` with surrogates, ``n_replaced``, ``kinds`` (in order) for each row of ``docs``.

    Equal finds (letter case and separators aside) have equal surrogates over the whole table, different
    finds of a kind different ones, and no surrogate is itself found in the table. Texts without finds
    stay as they are; null and empty texts become empty ones. Repeated rows are rewritten alike, ids may be null
    or repeated, other columns are ignored, and an empty table gives an empty result. ``key`` has 1 to 64 bytes.
    """
    doc, text = F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        doc.alias("doc"), text.alias("text"), F.xxhash64(doc, text).alias("k1"), F.xxhash64(F.lit(1), doc, text).alias("k2")
    )
    kind = docs.schema[id_col].dataType.simpleString()
    finds = stored(keyed.select("k1", "k2", "text").mapInArrow(_finds, "k1 long, k2 long, kind string, canon string"))
    anew = attempts(finds, key).filter("attempt > 0").select("kind", "canon", "value")
    again = finds.distinct().join(anew, ["kind", "canon"]).groupBy("k1", "k2")
    again = stored(again.agg(F.collect_list(F.struct("kind", "canon", "value")).alias("again")))
    rewritten = keyed.join(again, ["k1", "k2"], "left").select("doc", "text", "again")
    return rewritten.mapInArrow(_rewritten(key), f"doc {kind}, text string, n_replaced long, kinds array<string>")
