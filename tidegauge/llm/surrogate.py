"""Surrogates for personal data: keyed, consistent, of the same type and form.

Entities are found by pattern: e-mail addresses, telephone numbers, IPv4 and IPv6
addresses, card numbers (13 to 19 digits that pass the Luhn test), IBANs, national ids of the form
000-00-0000, secrets (assigned to a name such as token or password, or of a known
form), and names of persons (capitalised words, with particles such as "van der" between,
after a title or a known given name, or two to four of them beside a word that says that
they name someone, such as "met" or "wrote", or joined with such names; and each of these
words alone wherever else the document has it).
Each has a normal form in which spellings of one entity agree (case, separators), so
an entity gets the same surrogate wherever it occurs.

A surrogate is drawn character by character from HMAC-SHA-256 of key, type, normal
form and attempt: digits become digits, letters letters of the same script and case
(vowels vowels in names), marks and lengths stay. The type holds as well: octets of
an address stay octets, with as many digits, private ranges stay private; a card number
still passes the Luhn test; an IBAN keeps its country and valid check
digits; known given names are permuted among those of their gender and script; a
title, and with it a gender, stays.

Collision checks. All distinct entities of the table are gathered, once each. An
entity whose first surrogate is that of another entity, or is itself an entity of the
table, moves to the next attempt until none collides; the entity that sorts first
keeps a surrogate two want. Given names and surnames are compared as one type here, and
so are numbers of all types, without their marks. From the EASY_ATTEMPTS-th attempt on the form gives way
(longer words, free octets), so this ends. What differs from the first attempt is a
short list of exceptions, broadcast up to BROADCAST_ROWS rows; more than that reach
their documents by a join on the mentions instead.

Texts are read twice and do not shuffle (but for that join). Only entities do. Tables of
entities lie in the scratch folder, the whole one until the exceptions are known; these go
with the folder.

Defined results: null and empty texts stay as they are with 0 entities; null ids and
other columns pass through; repeated rows are replaced alike; an empty table gives an
empty result; an entity inside a longer one counts as part of it.
"""

from __future__ import annotations

import hmac
import re
from bisect import bisect_left
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.session import drop, materialise, ship

#: Give your own: who has the key can test guesses.
KEY = b"tidegauge"
EASY_ATTEMPTS = 8
BROADCAST_ROWS = 50_000

# Given names by script and gender, titles by gender, and alphabets.
GIVEN = {
    ("latin", "f"): "Alice Amelia Ana Anna Barbara Camille Carla Carmen Charlotte Claire Clara Elena Elizabeth Emily Emma Eva Hannah Helen Ingrid Isabel Jane Jennifer Jessica Julia Karen Laura Linda Lisa Lucia Maria Marie Martha Mary Nancy Olivia Patricia Rachel Sarah Sofia Sophie Susan Teresa".split(),
    ("latin", "m"): "Alan Albert Andrew Anthony Antonio Carlos Charles Daniel David Diego Edward Felix Francisco Frank George Hans Henry Jack James Jean John Jorge Joseph Juan Karl Kevin Klaus Lucas Luis Mark Martin Michael Miguel Paul Peter Pierre Richard Robert Stefan Steven Thomas William".split(),
    ("cyrillic", "f"): "Анна Вера Екатерина Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
    ("cyrillic", "m"): "Александр Алексей Андрей Владимир Дмитрий Иван Михаил Николай Павел Сергей".split(),
}
TITLES = {"f": "Mrs Ms Miss Mme Mlle Frau Sra Srta Señora".split(), "m": "Mr Herr Sr Señor Monsieur".split(), "": "Dr Prof".split()}
ALPHABETS = ["aeiou", "bcdfghjklmnpqrstvwxyz", "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ"]
ACCENTED = {**dict.fromkeys("àáâãäåæèéêëìíîïòóôõöøœùúûüýÿ", 0), **dict.fromkeys("çñßšžðþł", 1)}

KIND_OF_NAME = {name: kind for kind, names in GIVEN.items() for name in names}
CLASS_OF = {c: i for i, alphabet in enumerate(ALPHABETS) for c in alphabet} | ACCENTED

_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
_WORD = rf"(?!(?:{_TITLE})\b)[^\W\d_a-zà-öø-ÿа-яα-ω](?:[^\W\d_]+|['’](?!s\b)[^\W\d_]+)(?:(?:-|['’](?!s\b))[^\W\d_]+)*"
_PARTICLES = r"(?:(?:van|von|vom|der|den|des|de|del|della|di|da|dos|das|du|la|le|las|los|ter|ten|zu|zum|zur|bin|ibn|al|el)\s+)*"
PATTERNS: list[tuple[str, str]] = [
    ("secret", r"(?i:\b(?:api[_-]?key|access[_-]?key|auth[_-]?token|token|secret|password|passwd|pwd)\b[\"']?\s*[:=]\s*[\"']?)(?P<secret>[\w\-./+=]{6,})"),
    ("secret", r"(?<![\w])(?P<secret1>(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_-]{20,}|(?=[0-9]*[a-fA-F])(?=[a-fA-F]*[0-9])(?:[0-9a-f]{32,}|[0-9A-F]{32,}))(?![\w])"),
    ("email", r"(?<![\w.+%-])(?P<email>[\w.+%-]++@(?:[\w-]++\.)+[^\W\d_]{2,})"),
    ("iban", r"(?<!\w)(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)"),
    ("ipv6", r"(?<![\w:])(?P<ipv6>(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])"),
    ("ipv4", r"(?<![\w.])(?P<ipv4>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?!\w|\.\d)"),
    ("national", r"(?<![\w-])(?P<national>\d{3}-\d{2}-\d{4})(?![\w-])"),
    ("number", r"(?<![\w.])(?P<number>\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?!\w|\.\d)"),
    ("phone", r"(?<![\w.])(?P<phone>\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4}|[2-9]\d{2}[2-9]\d{6}|0\d{2,4}[ /-]\d{3,4}(?:[ .-]?\d{2,4}){1,2})(?!\w|\.\d)"),
]
MARKED = re.compile("|".join(p for _, p in PATTERNS))
#: No marked entity is without one of these or a prefix; patterns are tried this near to one, and to the end of the word there.
CLUES = re.compile(r"[\d@=:]+")
#: Secrets of known form may be letters only.
PREFIXES = ["AKIA", "ASIA", *(f"gh{c}_" for c in "pousr"), "sk-"]
CLUES_AND_PREFIXES = re.compile("|".join([CLUES.pattern, *PREFIXES]))
NEAR = 80
LONGEST_WORD = 1000
_GIVEN = "|".join([*KIND_OF_NAME, *(n.upper() for n in KIND_OF_NAME)])
NAMED = re.compile(rf"\b(?P<title>{_TITLE})\b\.?(?P<gap>\s+)(?P<words>{_PARTICLES}{_WORD}(?:\s+{_PARTICLES}{_WORD})*)|(?<![\w-])(?P<given>{_GIVEN})\b(?:-[^\W\d_]+)*(?P<rest>(?:\s+{_PARTICLES}{_WORD})+)")
# Words before or after a full name that say that it is one, words between names, and words that begin a sentence but no name.
_BEFORE = "met|written by|signed by|sent by|letter from|mail from|message from|spoke to|spoke with|talked to|talked with|married to|called|named|dear|hi|hello|regards|sincerely|contact|patient|client|customer|employee|author|my name is|his name is|her name is|signed|told|asked|married"
_AFTER = "said|says|wrote|writes|met|told|asked|called|lives|lived|works|worked|was born|born|married|died|joined|signed|replied|answered|agreed|explained|reported|added"
_BETWEEN = r"(?:\s*,\s*|\s+(?:and|or|und|et|y|e)\s+)"
_STARTERS = "The|A|An|This|That|These|Those|In|On|At|By|For|From|With|To|And|But|Or|If|When|While|After|Before|Then|There|Here|Yesterday|Today|Tomorrow|Dear|Hi|Hello|I|It|We|You|He|She|They|My|Our|Your|His|Her|Their|Later"
_FULL = rf"(?!(?:{_STARTERS})\b){_WORD}(?:[ \t]+{_PARTICLES}{_WORD}){{1,3}}(?!\w)"
_FULLS = rf"{_FULL}(?:{_BETWEEN}{_FULL})*"
#: A full name of any words, known by what stands beside it.
IN_CONTEXT = re.compile(rf"(?<!\w)(?i:{_BEFORE})[ \t]*[,:]?[ \t]+(?P<after>{_FULLS})|(?<![\w-])(?P<before>{_FULLS})(?=,?[ \t]+(?:{_AFTER})(?!\w))")
#: The longest word of each of these: a text without them needn't be searched.
CONTEXT_WORDS = frozenset(max(cue.split(), key=len) for cues in (_BEFORE, _AFTER) for cue in cues.split("|"))
TWO_CAPITALS = re.compile(rf"(?<!\w){_WORD}[ \t]+{_PARTICLES}{_WORD}")
FULL = re.compile(_FULL)
WORD = re.compile(_WORD)
ALONE = re.compile(rf"(?<!\w){_WORD}(?!\w)")
PART = re.compile(r"[^-]+")
CAPITALISED = re.compile(r"[^\W\d_a-zà-ÿ][^\W\d_]+")
NAME_WORDS = frozenset(KIND_OF_NAME) | {n.upper() for n in KIND_OF_NAME} | {t for titles in TITLES.values() for t in titles}


class Keyed:
    """An endless stream of numbers from a key and what it is for."""

    def __init__(self, key: bytes, *what: object):
        self.key, self.what, self.block, self.left = key, "\x00".join(map(str, what)).encode("utf-8", "surrogatepass"), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hmac.digest(self.key, self.what + self.block.to_bytes(4, "big"), "sha256")
            self.block += 1
        value, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return value % n


# --- finding ---------------------------------------------------------------------------------


def normal(kind: str, value: str) -> str:
    if kind == "email":
        return value.lower()
    if kind in ("phone", "number"):
        return re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind in ("ipv6", "surname"):
        return value.lower()
    if kind == "given" and value not in KIND_OF_NAME:
        return value.capitalize()
    if kind == "secret" and re.fullmatch(r"[0-9a-fA-F]+", value):
        return value.lower()
    return value


def _windows(text: str):
    """Parts of the text near clues, apart and in order."""
    start = end = 0
    clues = CLUES_AND_PREFIXES if any(p in text for p in PREFIXES) else CLUES
    for clue in clues.finditer(text):
        a, b = clue.span()
        if a - NEAR <= end:
            end = b + NEAR
            continue
        if end:
            yield start, end
        start, end = max(0, a - NEAR), b + NEAR
    if end:
        yield start, end


def _whole_words(text: str, windows):
    last = 0
    for start, end in windows:
        a = max(last, text.rfind(" ", max(0, start - LONGEST_WORD), start) + 1 or start)
        b = text.find(" ", end, end + LONGEST_WORD)
        b = min(len(text), end if b < 0 else b)
        if b > a:
            yield a, b
        last = max(last, b)


def _bare(word: str) -> str:
    return word.strip(".,:;!?\"'()")


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities, in order and apart."""
    found = []
    for a, b in _whole_words(text, _windows(text)):
        for match in MARKED.finditer(text, a, b):
            name = match.lastgroup
            if name == "number" and luhn_sum(re.sub(r"\D", "", match[name])):
                continue  # no card has it
            found.append((*match.span(name), name.rstrip("1")))
    listed = not NAME_WORDS.isdisjoint(CAPITALISED.findall(text))
    in_context = not CONTEXT_WORDS.isdisjoint(map(_bare, text.lower().split())) and TWO_CAPITALS.search(text) is not None
    if listed or in_context:
        found = sorted(found + _names(text, found, listed, in_context))
    return found


def _names(text: str, taken: list[tuple[int, int, str]], listed: bool, in_context: bool) -> list[tuple[int, int, str]]:
    """Words of full mentions of persons, then what else the text has of these words. taken: in order and apart."""
    starts = [a for a, _, _ in taken]

    def is_free(start: int, end: int) -> bool:
        at = bisect_left(starts, end) - 1
        return at < 0 or taken[at][1] <= start

    names: dict[int, tuple[int, int, str]] = {}
    known: dict[str, str] = {}
    spans = [match.span("words") if match["title"] else match.span() for match in NAMED.finditer(text)] if listed else []
    if in_context:
        spans += [span for match in IN_CONTEXT.finditer(text) for full in FULL.finditer(text, *match.span(match.lastgroup)) for span in [full.span()]]
    for first, last in spans:
        leading = True
        for word in WORD.finditer(text, first, last):
            leading = leading and word[0].capitalize() in KIND_OF_NAME
            kind = "given" if leading else "surname"
            if is_free(*word.span()) and word.start() not in names:
                names[word.start()] = (*word.span(), kind)
                for part in {word[0], *word[0].split("-")}:
                    if len(part) > 1:
                        known.setdefault(part.lower(), "given" if part.capitalize() in KIND_OF_NAME and kind == "given" else "surname")
    if known:
        for word in ALONE.finditer(text):
            if word.start() in names or not is_free(*word.span()):
                continue
            spans = [word.span()] if word[0].lower() in known else [(word.start() + p.start(), word.start() + p.end()) for p in PART.finditer(word[0])]
            for a, b in spans:
                if text[a:b].lower() in known:
                    names[a] = (a, b, known[text[a:b].lower()])
    return list(names.values())


# --- surrogates ------------------------------------------------------------------------------


def _letters(value: str, keyed: Keyed, keep_kind: bool = False) -> str:
    out = []
    for char in value:
        low = char.lower()
        group = CLASS_OF.get(low)
        if char.isdecimal():
            new = chr(ord(char) - int(char) + keyed.below(10))
        elif group is None:
            new = char
        else:
            alphabet = ALPHABETS[group] if keep_kind else ALPHABETS[group & ~1] + ALPHABETS[group | 1]
            new = alphabet[keyed.below(len(alphabet))]
            new = new.upper() if char != low else new
        out.append(new)
    return "".join(out)


def _hex(value: str, keyed: Keyed) -> str:
    return "".join("0123456789abcdef"[keyed.below(16)] if c in "0123456789abcdef" else c for c in value)


def luhn_sum(digits: str) -> int:
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(int(c) for c in reversed(digits))) % 10


def _number(digits: str, keyed: Keyed) -> str:
    new = digits[0] + "".join(str(keyed.below(10)) for _ in digits[1:])
    return next(x for x in (new[:-1] + str(d) for d in range(10)) if luhn_sum(x) == 0)


def _octets(value: str, keyed: Keyed, free: bool) -> str:
    old = value.split(".")
    fixed = 1 if old[0] in ("10", "127") else 2 if value.startswith("192.168.") or (old[0] == "172" and 16 <= int(old[1]) <= 31) else 0
    new = old[:fixed]
    for octet in old[fixed:]:
        low, high = (1, 254) if free else {1: (1, 9), 2: (10, 99)}.get(len(str(int(octet))), (100, 254))
        pick = low + keyed.below(high - low + 1)
        if not new and not free and high == 254:
            pick = 100 + (pick - 100) % 124  # an ordinary address
        new.append(str(pick))
    return ".".join(new)


def iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


@lru_cache(64)
def _permuted(key: bytes, script: str, gender: str, attempt: int) -> dict[str, str]:
    """A cycle through the known given names, so that none stays and no two meet."""
    names = sorted(GIVEN[script, gender], key=lambda n: hmac.digest(key, f"given{n}".encode(), "sha256"))
    step = 1 + attempt % (len(names) - 1)
    return {n: names[(i + step) % len(names)] for i, n in enumerate(names)}


def surrogate(kind: str, norm: str, attempt: int, key: bytes = KEY) -> str:
    """Of a normal form, another normal form."""
    if kind == "given":
        return _permuted(key, *KIND_OF_NAME[norm], attempt)[norm]
    keyed = Keyed(key, kind, norm, attempt)
    more = max(0, attempt - EASY_ATTEMPTS + 1)
    if kind == "email":
        local, _, domain = norm.rpartition("@")
        labels = domain.split(".")
        top = labels.pop()
        host = Keyed(key, "domain", domain)
        return f"{_letters(local, keyed)}{_letters('a' * more, keyed)}@{'.'.join(_letters(x, host) for x in labels)}.{top}"
    if kind in ("phone", "national"):
        first = next((i for i, c in enumerate(norm) if c.isdecimal()), 0)
        new = _letters(norm[first + 1 :], keyed)
        return norm[: first + 1] + new + _letters("0" * more, keyed)
    if kind == "number":
        return _number(norm + "0" * more, keyed)
    if kind == "ipv4":
        return _octets(norm, keyed, more > 0)
    if kind == "ipv6":
        return _hex(norm, keyed) + _hex("0" * more, keyed)
    if kind == "iban":
        rest = _letters(norm[4:].lower(), keyed).upper() + _letters("0" * more, keyed)
        return norm[:2] + iban_check(norm[:2], rest) + rest
    if kind == "secret":
        return (_hex if re.fullmatch(r"[0-9a-f]{16,}", norm) else _letters)(norm, keyed) + _letters("0" * more, keyed)
    return _letters(norm, keyed, keep_kind=True) + _letters("a" * more, keyed)


def written(kind: str, original: str, norm: str, new: str) -> str:
    """The surrogate in the original's spelling: its separators and its case."""
    if kind in ("phone", "number", "iban"):
        chars = iter(new)
        out = "".join(next(chars, "") if c.isalnum() else c for c in original) + "".join(chars)
        return out
    if norm != original:  # the normal form is in lower case
        if original.upper() == original:
            return new.upper()
        return "".join(n.upper() if i < len(original) and original[i].isupper() else n for i, n in enumerate(new))
    return new


def replaced(text: str, attempts: dict[tuple[str, str], int], key: bytes) -> tuple[str, int]:
    found = find(text)
    if not found:
        return text, 0
    out, at = [], 0
    for start, end, kind in found:
        original = text[start:end]
        norm = normal(kind, original)
        out += [text[at:start], written(kind, original, norm, surrogate(kind, norm, attempts.get((kind, norm), 0), key))]
        at = end
    return "".join([*out, text[at:]]), len(found)


# --- over a table ----------------------------------------------------------------------------


def _find_rows(with_key: bool):
    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            rows = []
            for i, text in enumerate(texts):
                if text:
                    rows += [(i, kind, normal(kind, text[a:b])) for a, b, kind in find(text)]
            if not with_key:
                rows = [(0, *x) for x in {x[1:] for x in rows}]
            at = [r[0] for r in rows]
            arrays = [pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())]
            names = ["kind", "norm"]
            if with_key:
                arrays, names = [batch.column(0).take(pa.array(at, pa.int64())), *arrays], ["text_key", *names]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _candidates(key: bytes):
    def run(batches):
        for batch in batches:
            new = [surrogate(*row, key) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], names=["kind", "norm", "attempt", "candidate"])

    return run


def exceptions_of(entities: DataFrame, key: bytes) -> DataFrame:
    """A written table (kind, norm, attempt) of the entities whose first surrogate collides. entities: distinct (kind, norm)."""

    def tried(df: DataFrame) -> DataFrame:
        return materialise(df.select("kind", "norm", "attempt").mapInArrow(_candidates(key), "kind string, norm string, attempt int, candidate string"), "candidates")

    def compared(df: DataFrame, value: str) -> DataFrame:
        """With what must differ: the group of kinds and the bare form."""
        group = F.when(F.col("kind").isin("given", "surname"), "name").when(F.col("kind").isin("phone", "number", "national"), "digits").otherwise(F.col("kind"))
        form = F.when(group == "name", F.lower(value)).when(group == "digits", F.regexp_replace(value, "-", "")).otherwise(F.col(value))
        return df.withColumns({"group": group, "form": form})

    reals = compared(entities, "norm").groupBy("group", "form").agg(F.max(F.lit(True)).alias("is_real"), F.max(F.col("kind") != "given").alias("is_other"))
    settled: DataFrame | None = None
    open_rows = tried(entities.withColumn("attempt", F.lit(0)))
    while True:
        rows = compared(open_rows, "candidate")
        first = rows.groupBy("group", "form").agg(F.min(F.struct("kind", "norm")).alias("first"))
        judged = rows.join(first, ["group", "form"]).join(reals, ["group", "form"], "left")
        # given names are permuted among themselves; where nearly every form is taken, distinctness alone must do
        taken_by_real = F.coalesce(F.when(F.col("kind") == "given", F.col("is_other")).otherwise(F.col("is_real")), F.lit(False))
        judged = judged.withColumn("bad", (F.struct("kind", "norm") != F.col("first")) | (taken_by_real & (F.col("attempt") < 4 * EASY_ATTEMPTS)))
        if settled is not None:
            judged = judged.join(settled.select("group", "form", F.lit(True).alias("is_taken")), ["group", "form"], "left").withColumn("bad", F.col("bad") | F.col("is_taken").isNotNull())
        judged = materialise(judged.select("kind", "norm", "attempt", "candidate", "group", "form", "bad"), "judged")
        good = judged.filter(~F.col("bad")).drop("bad")
        before, settled = settled, materialise(good if settled is None else settled.union(good), "settled")
        bad = judged.filter("bad")
        done = bad.isEmpty()
        again = None if done else tried(bad.withColumn("attempt", F.col("attempt") + 1))
        drop(before, open_rows, judged)
        if done:
            found = materialise(settled.filter("attempt > 0").select("kind", "norm", "attempt"), "exceptions")
            drop(settled)
            return found
        open_rows = again


def _replace(key: bytes, shared):
    def run(batches):
        attempts = {(k, n): a for k, n, a in shared.value} if shared is not None else {}
        for batch in batches:
            texts, counts = [], []
            own = batch.column("exceptions").to_pylist() if shared is None else [None] * batch.num_rows
            for at in range(0, batch.num_rows, 512):
                for text, extra in zip(batch.column("text").slice(at, 512).to_pylist(), own[at : at + 512], strict=True):
                    special = {(x["kind"], x["norm"]): x["attempt"] for x in extra} if extra else attempts
                    new, n = replaced(text, special, key) if text else (text, 0)
                    texts.append(new)
                    counts.append(n)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], names=["row", "text", "n_entities"])

    return run


def replace_entities(docs: DataFrame, text_col: str = "text", key: bytes = KEY, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """docs with surrogates in the text, and n_entities, the number replaced. A column n_entities that docs has is overwritten."""
    spark = docs.sparkSession
    ship(spark)
    text = F.col(text_col).cast("string")
    entities = materialise(docs.select(text).mapInArrow(_find_rows(False), "kind string, norm string").distinct(), "entities")
    exceptions = exceptions_of(entities, key)
    drop(entities)
    rest = [c for c in docs.columns if c not in (text_col, "n_entities")]
    row = F.struct(*rest) if rest else F.struct(F.lit(0).alias("none"))
    rows = docs.select(row.alias("row"), text.alias("text"))
    shared = None
    if exceptions.count() <= broadcast_rows:
        shared = spark.sparkContext.broadcast([tuple(r) for r in exceptions.collect()])  # at most broadcast_rows
    else:
        keyed = docs.select(F.xxhash64(text).alias("text_key"), text)
        mentions = keyed.mapInArrow(_find_rows(True), "text_key long, kind string, norm string").distinct().join(exceptions, ["kind", "norm"])
        lists = materialise(mentions.groupBy("text_key").agg(F.collect_list(F.struct("kind", "norm", "attempt")).alias("exceptions")), "mentions")  # one text's entities
        rows = rows.withColumn("text_key", F.xxhash64("text")).join(lists, "text_key", "left").drop("text_key")
    row_type = rows.schema["row"].dataType.simpleString()
    done = rows.mapInArrow(_replace(key, shared), f"row {row_type}, text string, n_entities long")
    return done.select(*(F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns if c != "n_entities"), "n_entities")
