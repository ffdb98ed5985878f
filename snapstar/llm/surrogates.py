"""Surrogates for personal data.

Detected entities (mail addresses, telephone numbers, IP addresses, payment
cards, access keys, names of persons) are replaced by keyed surrogates of the same
type.  A surrogate keeps the format: letters stay letters of the same case and
script, digits stay digits, separators stay where they are; cards keep their
leading digit and a valid check digit, telephone numbers their country code, and
given names are drawn from names of the same gender and script.

A person is a given name of the list below (with initials, further given names or
a hyphen) before a surname; ``Alice`` or ``Smith`` alone is replaced where the same
text has the whole name, and stays elsewhere, as do persons without a listed given
name and names all in small or large letters.  Telephone numbers are found in
three groups, with a country code (+ or 00) in any groups, and with a leading 0
from nine digits; ten digits in one piece and numbers without an area code stay.

Each surrogate comes from a keyed permutation of all strings of its format, so
the same value gets the same surrogate in every document (coreference) and
different values of one format get different ones (distinctness).  The distinct
surrogates of the corpus are checked all the same: a surrogate that two values
share, or that is itself a value found in the corpus, is drawn again with the
next attempt number.  Values that needed that are joined to the documents that
hold them; all others are replaced where they stand, without a lookup.

Rows: null text stays null; empty and clean texts stay as they are; repeated rows
are replaced alike; an empty table gives an empty result; further columns are
ignored.  Texts of any length are read whole.
"""

from __future__ import annotations

import functools
import hashlib
import hmac
import ipaddress
import re
import string
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstar.llm.common import map_arrow
from snapstar.session import stage

MAX_ATTEMPTS = 8

# Given names by gender and script, in alphabetical order.
GIVEN = {
    ("f", "latin"): (
        "Abigail Adriana Agnes Alexandra Alice Alicia Alina Amanda Amelia Amy Ana Andrea Angela Angelika Anna Anne Annette Antonia Barbara Beatrice Beatriz "
        "Brigitte Camille Carla Carmen Carol Caroline Catherine Charlotte Chloe Christina Christine Claire Clara Claudia Cristina Cynthia Daniela Deborah Diana "
        "Dorothy Elena Elizabeth Ella Emily Emma Erika Esther Eva Fatima Fiona Florence Franziska Gabriela Gabriele Gloria Hannah Heather Heike Helen Helena "
        "Ines Ingrid Irene Isabel Isabella Jacqueline Jane Janet Jennifer Jessica Joan Johanna Josephine Judith Julia Julie Karen Karin Katharina Katherine "
        "Kathleen Kimberly Laura Lea Lena Leonie Linda Lisa Louise Lucia Lucy Manon Margaret Maria Marie Marion Marta Martha Martina Mary Megan Melanie Melissa "
        "Michelle Monica Monika Nadine Nancy Natalie Nathalie Nicole Nina Nora Olivia Pamela Patricia Paula Petra Pilar Rachel Rebecca Renate Rosa Ruth Sabine "
        "Samantha Sandra Sara Sarah Silvia Sofia Sophia Sophie Stefanie Stephanie Susan Susanne Sylvie Teresa Theresa Ursula Valentina Valerie Vanessa Veronica "
        "Victoria Virginia Wendy Yvonne Zoe "
    ).split(),
    ("m", "latin"): (
        "Aaron Adam Adrian Alan Albert Alejandro Alexander Alfred Andreas Andrew Anthony Antoine Antonio Arthur Arturo Benjamin Bernard Bernd Bob Brian Bruno "
        "Carl Carlos Charles Christian Christopher Claude Craig Daniel David Dennis Diego Dieter Dirk Donald Douglas Eduardo Edward Emmanuel Enrique Eric Erik "
        "Ernst Felix Fernando Florian Francis Francisco Franz Frederic Friedrich Gabriel Gary George Gerald Gerhard Gregory Guillaume Gustav Hans Harold Harry "
        "Heinrich Helmut Henri Henry Herbert Hugo Ivan Jack Jacob Jacques James Jan Jason Javier Jean Jeffrey Jerome Jerry Joachim Joel Johann Johannes John "
        "Jonathan Jorge Jose Joseph Joshua Juan Julian Julien Justin Karl Kenneth Kevin Klaus Kurt Larry Laurent Leo Leon Louis Luca Lucas Luis Lukas Manfred "
        "Manuel Marc Marcel Marco Markus Martin Mathieu Matthew Matthias Maximilian Michael Michel Miguel Nathan Nicholas Nicolas Niklas Oliver Olivier Oscar "
        "Otto Pablo Pascal Patrick Paul Pedro Peter Philip Philippe Pierre Rafael Raimund Ralph Raymond Richard Robert Roberto Roger Roland Ronald Samuel Scott "
        "Sebastian Sergio Simon Stefan Stephan Stephen Steven Thierry Thomas Timothy Tobias Tom Uwe Victor Vincent Walter Werner William Wolfgang Xavier "
        "Yannick "
    ).split(),
    ("f", "accented"): (
        "Aurélie Bärbel Céline Chloé Désirée Élise Élodie Françoise Geneviève Hélène Inès Inés Jördis Käthe Léa Lucía María Mónica Núria Rocío Sofía Thérèse "
        "Verónica Zoé "
    ).split(),
    ("m", "accented"): (
        "Álvaro André Andrés Ángel Björn Cédric François Frédéric Gérard Günter Günther Íñigo Jérôme Jesús Joaquín Jörg José Jürgen Léon Martín Matías Nicolás "
        "Óscar Ramón Raúl René Rubén Sébastien Sören Stéphane Tomás Víctor "
    ).split(),
    ("f", "cyrillic"): ["Анна", "Вера", "Елена", "Ирина", "Мария", "Наталья", "Ольга"],
    ("m", "cyrillic"): ["Алексей", "Борис", "Виктор", "Иван", "Николай", "Олег", "Павел"],
    ("f", "greek"): ["Άννα", "Ελένη", "Ιωάννα", "Μαρία", "Σοφία"],
    ("m", "greek"): ["Αλέξανδρος", "Γιώργος", "Δημήτρης", "Νίκος", "Πέτρος"],
}
_GENDER = {name: key for key, names in GIVEN.items() for name in names}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_BY_LETTER = {c: sorted((n[1:] for n in _GENDER if n[0] == c), key=len, reverse=True) for c in sorted({n[0] for n in _GENDER})}
_NAME = "(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in _BY_LETTER.items()) + ")"
_CAPITAL = r"[^\W\d_a-zß-öø-ÿа-яёα-ωά-ώ]"
_SURNAME = rf"(?:{_CAPITAL}['’])?{_CAPITAL}[^\W\d_]+(?:-{_CAPITAL}[^\W\d_]+)*"
_PLAIN_PHONE = r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}|\+\d{8,14}"
_FORMS = (
    r"(?P<email>(?<![\w.+-])[A-Za-z0-9](?:[A-Za-z0-9._+-]*[A-Za-z0-9])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?![\w@]))",
    r"(?P<key>(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9]))",
    rf"(?P<ip>(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\w))",
    r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    rf"(?P<phone>(?<![\w+])(?:{_PLAIN_PHONE})(?!\w)"
    r"|(?<![\w+])(?:\+|00(?=[1-9]))\d{1,3}(?:(?: ?/ ?| ?\(\d{1,5}\) ?|[ .-])\d{1,10}){1,6}(?!\w)"
    r"|(?<![\w+.-])0\d(?P<gap>[ .-])\d\d(?:(?P=gap)\d\d){3}(?!\w|[.-]\w)"
    r"|(?<![\w+.-])(?:\(0\d{1,4}\) ?|0\d{1,4}(?: ?/ ?|[ -]))\d{3,8}(?:[ -]\d{2,5}){0,2}(?!\w|[.-]\w))",
    rf"(?P<name>(?<!\w)(?={_CAPITAL}){_NAME}(?:-{_CAPITAL}[^\W\d_]+)?(?:\s(?:{_NAME}|{_CAPITAL}\.)(?=\s)){{0,2}}\s(?:(?:van|von|der|den|de|del|la|di|du|zu)\s){{0,2}}{_SURNAME}(?!\w))",
)
#: Countries' codes of one and two digits (all others have three), and the most
#: digits of a number with its code, where that is less than fifteen.
_CODE = re.compile(r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")
_MOST = {"1": 11, "7": 11, "30": 12, "31": 11, "32": 11, "33": 11, "34": 11, "39": 12, "41": 11, "43": 13, "44": 12, "45": 10, "46": 12, "47": 10, "48": 11, "49": 13, "351": 12, "353": 12}
#: Words that are no one's short name, though they follow a given name.
_NO_NAME = frozenset("A An And As At But By For From He Her His How I If In It My No Not Of On Or Our She So That The Their Then There They This To We What When Where Who Why With You "
                     "Aber Als Am Auf Aus Bei Da Das Dem Den Der Die Ein Eine Er Es Ich Ihr Im Ist Mit Nach Sie Sein Um Und Von Was Wie Wir Zu "
                     "Au Aux Ce Ces Dans De Des Du Elle Elles En Est Et Il Ils Je La Le Les Mais Nous On Ou Par Pour Que Qui Sur Un Une Vous "
                     "Con Del El Ella En Es Lo Los Las Ni Pero Por Se Si Su Una Uno Y Yo".split())
#: Every form but cards, and where a run of digits begins that may hold cards.
_OTHERS = re.compile("|".join(_FORMS))
PATTERNS = re.compile("|".join((*_FORMS[:3], r"(?P<run>(?<![\w.])\d(?:[ -]?\d){12})", *_FORMS[3:])))
_RUN = re.compile(r"\d+(?:[ -]\d+)*")
#: Cards as they are printed, the likelier reading of a start first.
_PRINTED = tuple(re.compile(rf"(?<![\w.])(?:{form})(?!\w)") for form in (
    r"\d{4}([ -])\d{4}\1\d{4}\1\d{4}", r"\d{4}([ -])\d{6}\1\d{4,5}", r"\d{13,19}", r"\d{4}([ -])\d{4}\1\d{4}\1\d{4}\1\d{1,3}", r"\d{4}([ -])\d{4}\1\d{4}\1\d{1,3}",
    r"\d{4}([ -])\d{4}\1\d{5}", r"\d{4}([ -])\d{3}\1\d{3}\1\d{3}"))
#: First digits and lengths of the payment systems.
_ISSUED = re.compile(r"4(?:\d{12}|\d{15}|\d{18})|5[1-5]\d{14}|2[2-7]\d{14}|3[47]\d{13}|3[068]\d{12}|6\d{15,18}")
#: A text without any of these cannot hold an entity but a name.
_HINT = re.compile(r"\d|@")
_GIVEN_NAME = re.compile(rf"(?<!\w)(?={_CAPITAL}){_NAME}\b")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def detected(text: str) -> list[tuple[str, int, int]]:
    """(type, start, end) of the entities, from left to right.  ``given`` and
    ``surname`` are short mentions of a person whose whole name the text has."""
    found = []
    if not _HINT.search(text) and not _GIVEN_NAME.search(text):
        return found
    at = 0
    while m := PATTERNS.search(text, at):
        if m.lastgroup == "run":
            inside, at = _in_run(text, *_RUN.match(text, m.start()).span())
            found += inside
        else:
            at = _end(m)
            if at > m.start():
                found.append((m.lastgroup, m.start(), at))
            else:
                at = m.end()
    return _with_mentions(text, found)


def _end(m: re.Match) -> int:
    """Where the match ends: a telephone number in its international form where
    its country's longest numbers do; its start if it has too few digits."""
    value = m.group()
    if m.lastgroup != "phone" or re.fullmatch(_PLAIN_PHONE, value):
        return m.end()
    bare = re.sub(r"^(?:\+|00(?=[1-9]))", "", value)
    if len(bare) == len(value):  # a national number
        return m.end() if sum(map(str.isdigit, value)) >= 9 else m.start()
    most = _MOST.get(_CODE.match(re.sub(r"\D", "", bare) + "00").group(), 15)
    groups = [(g.start(), g.end()) for g in re.finditer(r"\d+", bare)]
    while len(groups) > 1 and sum(e - s for s, e in groups) > most:
        groups.pop()
    n = sum(e - s for s, e in groups)
    return m.start() + len(value) - len(bare) + groups[-1][1] if 7 <= n <= 15 else m.start()


def _parts(name: str) -> tuple[str, str]:
    """The given name and the surname that may stand for a whole name."""
    words = name.split()
    return words[0], words[-1]


def _with_mentions(text: str, found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    short: dict[str, str] = {}
    for k, s, e in found:
        if k == "name":
            given, surname = _parts(text[s:e])
            short |= {given: "given"} | ({} if surname in _NO_NAME else {surname: "surname"})
    if not short:
        return found
    form = re.compile(rf"(?<!\w)(?:{'|'.join(sorted(map(re.escape, short), key=len, reverse=True))})(?!\w)")
    out, at = [], 0
    for k, s, e in [*found, ("", len(text), len(text))]:
        out += [(short[m.group()], *m.span()) for m in form.finditer(text, at, s)]
        out.append((k, s, e))
        at = e
    return out[:-1]


def with_persons(text: str, found: list[tuple[str, int, int]]) -> list[tuple[str, str, int, int]]:
    """(type, canonical value, start, end); of a short mention the value is the
    whole name: the nearest before it that has this part, else the first after."""
    names = [(s, canonical(k, text[s:e])) for k, s, e in found if k == "name"]
    known: dict[tuple[str, str], str] = {}
    for _, v in reversed(names):
        known |= dict(zip((("given", _parts(v)[0]), ("surname", _parts(v)[1])), (v, v)))
    out = []
    for k, s, e in found:
        value = canonical(k, text[s:e])
        if k == "name":
            known |= dict(zip((("given", _parts(value)[0]), ("surname", _parts(value)[1])), (value, value)))
        out.append((k, known[k, value] if k in ("given", "surname") else value, s, e))
    return out


def _in_run(text: str, start: int, end: int) -> tuple[list[tuple[str, int, int]], int]:
    """The entities that begin in a run of digit groups, and where to go on.

    Printed cards with a valid check digit come first, wherever in the run they
    begin; then the other forms between them; what neither has taken may be a card
    in other groups.  A number printed like a card whose check digit is wrong is
    no telephone number either."""
    groups = [(start + g.start(), start + g.end()) for g in re.finditer(r"\d+", text[start:end])]
    cards, others, wrong, at = [], [], {}, start
    for s, _ in groups:
        if s < at:
            continue
        for k, form in enumerate(_PRINTED):
            if (m := form.match(text, s)) and m.end() <= end:
                if _valid(m.group()):
                    cards.append(("card", *m.span()))
                    at = m.end()
                    break
                if k == 0:
                    wrong[s] = m.end()
    last = end
    for s, e in zip([start, *(b for _, _, b in cards)], [*(a for _, a, _ in cards), None]):
        at = s
        while (m := _OTHERS.search(text, at, len(text) if e is None else e)) and m.start() < end:
            stop = _end(m)
            at = wrong.get(m.start(), stop if stop > m.start() else m.end())
            if m.start() not in wrong and stop > m.start():
                others.append((m.lastgroup, m.start(), stop))
                last = max(last, at)
    whole = text[start:end]
    if not cards and len(set(re.sub(r"\d", "", whole))) <= 1 and _valid(whole) and not re.match(r"\w", text[end:end + 1]):
        # One card in other groups, unless the other forms read all of it.
        if _ISSUED.fullmatch(re.sub(r"\D", "", whole)) or sum(min(e, end) - s for _, s, e in others) < len(whole) - len(others):
            return [("card", start, end)], end
    found = cards + others
    taken = bytearray(end - start)
    for _, s, e in found:
        taken[s - start:min(e, end) - start] = b"\1" * (min(e, end) - s)
    rest: list[list[tuple[int, int]]] = [[]]
    for g in groups:
        if not taken[g[0] - start]:
            rest[-1].append(g)
        elif rest[-1]:
            rest.append([])
    for part in rest:
        k = 0
        while k < len(part):
            ends = [e for _, e in part[k:k + 19]]
            for n, e in reversed(list(enumerate(ends))):
                value = text[part[k][0]:e]
                if (not k and n == len(part) - 1 or _ISSUED.fullmatch(re.sub(r"\D", "", value))) and _valid(value) and not re.match(r"\w", text[e:e + 1]):
                    found.append(("card", part[k][0], e))
                    k += n
                    break
            k += 1
    return sorted(found, key=lambda x: x[1]), last


def _valid(value: str) -> bool:
    digits = re.sub(r"\D", "", value)
    return 13 <= len(digits) <= 19 and luhn(digits)


def canonical(kind: str, value: str) -> str:
    """What makes two mentions the same entity."""
    if kind == "email":
        return value.lower()
    if kind in ("card", "phone"):
        return re.sub(r"[^\d+]", "", value)
    return re.sub(r"\s+", " ", value) if kind == "name" else value


class Permutation:
    """Keyed permutations of 0 .. n-1: an unbalanced Feistel network over the next
    power of four, walked until it is back in range."""

    def __init__(self, key: bytes):
        self.key = key

    def __call__(self, tweak: str, n: int, x: int) -> int:
        half = max(1, (n - 1).bit_length() + 1 >> 1)
        mask = (1 << half) - 1
        while True:
            a, b = x >> half, x & mask
            for k in range(8):
                digest = hmac.digest(self.key, f"{tweak}|{n}|{k}|{b}".encode(), hashlib.sha256)
                a, b = b, a ^ (int.from_bytes(digest, "big") & mask)
            x = a << half | b
            if x < n:
                return x


_ALPHABETS = (string.digits, string.ascii_lowercase, string.ascii_uppercase, "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
              "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")
_PLACE = {c: (a, k) for a in _ALPHABETS for k, c in enumerate(a)}


@functools.cache
def _page(start: int, category: str) -> str:
    """The other letters of one kind in a page of 128 characters: accented ones,
    and those of all further scripts."""
    return "".join(c for c in map(chr, range(start, start + 128)) if c not in _PLACE and unicodedata.category(c) == category)


def place(c: str) -> tuple[str, int] | None:
    """The alphabet of a letter or digit and its place there; no two alphabets
    share a letter."""
    if c in _PLACE or not c.isalpha():
        return _PLACE.get(c)
    page = _page(ord(c) & ~127, unicodedata.category(c))
    return (page, page.index(c)) if len(page) > 1 else None


def permuted(perm: Permutation, tweak: str, value: str) -> str:
    """``value`` with its letters and digits replaced by others of the same
    alphabets; one to one among the strings of its format."""
    places = [place(c) for c in value]
    n = x = 1
    x = 0
    for p in places:
        if p:
            n, x = n * len(p[0]), x * len(p[0]) + p[1]
    if n == 1:
        return value
    form = "".join(p[0][0] if p else c for p, c in zip(places, value))
    y = perm(f"{tweak}|{form}", n, x)
    out = []
    for p, c in zip(reversed(places), reversed(value)):
        if p:
            y, k = divmod(y, len(p[0]))
            c = p[0][k]
        out.append(c)
    return "".join(reversed(out))


def surrogate(perm: Permutation, kind: str, value: str, attempt: int = 0) -> str:
    """The surrogate of a canonical value."""
    tweak = f"{kind}|{attempt}"
    if kind == "email":
        local, _, domain = value.rpartition("@")
        labels = domain.split(".")
        return f"{permuted(perm, tweak + domain, local)}@{'.'.join([*(permuted(perm, tweak, d) for d in labels[:-1]), labels[-1]])}"
    if kind == "ip":
        n = int(ipaddress.IPv4Address(".".join(str(int(o)) for o in value.split("."))))
        return str(ipaddress.IPv4Address(perm(tweak, 1 << 32, n)))
    if kind == "card":
        body = value[0] + permuted(perm, tweak + value[0], value[1:-1])
        return next(body + str(c) for c in range(10) if luhn(body + str(c)))
    if kind == "phone":
        m = re.match(rf"(?:\+|00(?=[1-9]))(?:{_CODE.pattern})(?=\d{{4}})|0", value)
        head = m.group() if m else ""
        return head + permuted(perm, tweak + head, value[len(head):])
    if kind == "key":
        return value[:4] + permuted(perm, tweak, value[4:])
    if kind == "name":
        given = re.split(r"[ -]", value, maxsplit=1)[0]
        names = GIVEN[_GENDER[given]]
        # A keyed rotation: one to one, and never the name itself; the same with
        # and without what stands between given name and surname.
        turn = 1 + int.from_bytes(hmac.digest(perm.key, f"{tweak}|{_parts(value)[1]}|{_GENDER[given]}".encode(), hashlib.sha256)[:8], "big") % (len(names) - 1)
        rest = re.sub(r"[^ -]+", lambda w: w.group() if w.group().islower() else permuted(perm, tweak, w.group()), value[len(given):])
        return names[(names.index(given) + turn) % len(names)] + rest
    return permuted(perm, tweak, value)


def shaped(kind: str, mention: str, made: str) -> str:
    """The surrogate in the mention's own format (separators, case)."""
    if kind == "email":
        return made.upper() if mention.isupper() else made
    if kind in ("card", "phone"):
        digits = iter(made)
        return "".join(next(digits) if c.isdigit() or c == "+" else c for c in mention)
    if kind == "name":
        gaps = iter(re.findall(r"\s+", mention))
        return re.sub(" ", lambda _: next(gaps), made)
    if kind in ("given", "surname"):
        return _parts(made)[kind == "surname"]
    return made


def entity_batches(batches):
    for b in batches:
        rows = set()
        for i, t in zip(b.column(0), b.column(1)):
            if t.is_valid:
                text = t.as_py()
                rows |= {(i.as_py(), k, canonical(k, text[s:e])) for k, s, e in detected(text) if k not in ("given", "surname")}
        yield _batch(sorted(rows, key=str), ["doc_id", "kind", "value"])


def _batch(rows, names):
    cols = list(zip(*rows)) if rows else [()] * len(names)
    kinds = {"doc_id": pa.int64(), "attempt": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for c, n in zip(cols, names)], names)


def drawn_batches(batches, key):
    perm = Permutation(key)
    for b in batches:
        rows = b.to_pylist()
        yield _batch([(r["kind"], r["value"], r["attempt"], surrogate(perm, r["kind"], r["value"], r["attempt"])) for r in rows], ["kind", "value", "attempt", "made"])


def replaced_batches(batches, key):
    perm = Permutation(key)
    for b in batches:
        out = []
        for i, t, other in zip(b.column(0), b.column(1), b.column(2)):
            text = t.as_py()
            if text is None:
                out.append((i.as_py(), None, 0))
                continue
            special = {(x["kind"], x["value"]): x["made"] for x in other.as_py() or ()}
            at, parts, found = 0, [], with_persons(text, detected(text))
            for k, value, s, e in found:
                kind = "name" if k in ("given", "surname") else k
                made = special.get((kind, value)) or surrogate(perm, kind, value)
                parts += [text[at:s], shaped(k, text[s:e], made)]
                at = e
            out.append((i.as_py(), "".join([*parts, text[at:]]), len(found)))
        cols = list(zip(*out)) if out else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], ["doc_id", "text", "n_replaced"])


def _drawn(values: DataFrame, key: bytes) -> DataFrame:
    # Rows are small and their work is not: a stated number of partitions is not
    # merged by size.
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = values.select("kind", "value", "attempt").repartition(parts, "kind", "value")
    return stage(map_arrow(dealt, "snapstar.llm.surrogates:drawn_batches",
                           "kind string, value string, attempt int, made string", key=key), "surrogates")


def surrogate_table(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind, value, attempt, made`` of all distinct values, checked: no two
    values of a kind share a surrogate, and none is a value of the corpus."""
    values = entities.select("kind", "value").distinct()
    good = _drawn(values.withColumn("attempt", F.lit(0)), key)
    every = good.select("kind", F.col("value").alias("made"))
    for _ in range(MAX_ATTEMPTS):
        # Of the values that share a surrogate the smallest keeps it.
        first = good.groupBy("kind", "made").agg(F.min("value").alias("keeps"))
        taken = every.withColumn("real", F.lit(True))
        bad = (good.join(first, ["kind", "made"]).join(taken, ["kind", "made"], "left")
               .where("value <> keeps OR real").select("kind", "value", (F.col("attempt") + 1).cast("int").alias("attempt")))
        again = _drawn(bad, key)
        if not again.limit(1).count():
            return good
        good = stage(good.join(again.select("kind", "value"), ["kind", "value"], "left_anti").unionByName(again), "surrogates")
    raise ValueError("too few surrogates for the values of some kind")


def replace(docs: DataFrame, key: bytes) -> DataFrame:
    """``doc_id, text, n_replaced`` of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    entities = stage(map_arrow(rows, "snapstar.llm.surrogates:entity_batches", "doc_id long, kind string, value string"), "entities")
    special = surrogate_table(entities, key).where("attempt > 0")
    if special.limit(1).count():
        # A row for each document that holds such a value, with its own values.
        per_doc = (entities.where("doc_id IS NOT NULL").distinct().join(special, ["kind", "value"])
                   .groupBy("doc_id").agg(F.collect_list(F.struct("kind", "value", "made")).alias("special")))
        rows = rows.join(per_doc, "doc_id", "left")
    else:
        rows = rows.withColumn("special", F.lit(None).cast("array<struct<kind:string,value:string,made:string>>"))
    return map_arrow(rows.select("doc_id", "text", "special"), "snapstar.llm.surrogates:replaced_batches", "doc_id long, text string, n_replaced long", key=key)
