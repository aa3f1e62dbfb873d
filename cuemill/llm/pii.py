"""Problem 2: personal values inside free text.

Method: regular expressions propose spans; checksum and numbering-plan validators confirm them (Luhn, mod 97, mod 23,
mod 11); words nearby raise or lower the score; spans that reach the threshold come out, and are replaced by typed
placeholders in the redacted text. A text may be a list of pieces (segments): the pieces are read as one text joined by
spaces, so that a value may run over a piece boundary; it belongs to the piece in which it begins.

Defined results: null texts and pieces are empty texts; empty texts have no values; texts are read whole at any length;
equal spans of two kinds go to the kind with the higher score; repeated rows repeat their values.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuemill.runtime import segment_texts, text_of

KINDS = ("email", "phone", "id_number", "address", "name")
#: Frequent given names of several languages: evidence for a person where a bracket holds a name that nothing announces. A parameter
#: of the operator; announced names need not be listed.
GIVEN_NAMES = frozenset(
    """adam alan alex alice amelie ana andrea andreas anna anne anton antonio barbara beatriz ben carla carlos carmen charles chris christian
    clara claire daniel david diego dorothy elena elisa emil emily emma erik eva felix fiona francois frank george hannah hans helen henry
    isabel jack james jan jana jane jean jens joan joe johann john jonas jorge jose josef juan julia jurgen karen karl katja kevin klaus laura
    lea lena leo linda lisa louis louise lucas lucia luis luke marc maria marie mark marta martin mary max maya michael michel miguel mohammed
    monika nadja nicolas nina noah oliver olga omar pablo paul pedro peter petra philip pierre rachel robert rosa sam samuel sandra sara
    sarah sebastian simon sofia sophie stefan susan thomas tim tom uwe vera victor william yusuf zoe""".split()
)
#: Words of organisations, shows and places: a name that holds one is no person.
NOT_PERSON = frozenset(
    """academy talks tv notes workshop lab labs friends studio studios suite club kit team channel press desk records media music street lane
    ave avenue road station library group show podcast the a an and or to at of in on for from with by is are was were be this that it its
    we you they my our your und oder mit für von der die das den dem ein eine et ou avec pour de la le les un une des du y o con para el
    los las al que all every each us me him her them who asked last week today here mr mrs ms frau herr herrn monsieur madame mme señor señora""".split()
)


@dataclass(frozen=True)
class PiiParams:
    threshold: float = 0.5
    #: Characters before and after a proposal that are searched for context words.
    before: int = 44
    after: int = 24
    given_names: frozenset[str] = GIVEN_NAMES


# --- validators -----------------------------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97_iban(iban: str) -> bool:
    s = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in s)) % 97 == 1


def nir(digits: str) -> bool:
    """French social-security number: 13 digits and 97 minus their remainder."""
    return len(digits) == 15 and digits[0] in "12" and 97 - int(digits[:13]) % 97 == int(digits[13:])


def nie(value: str) -> bool:
    """Spanish DNI/NIE: the letter is the number's remainder by 23 in a fixed alphabet."""
    m = re.fullmatch(r"([XYZ]?)(\d{7,8})([A-Z])", value)
    return bool(m) and "TRWAGMYFPDXBNJZSQVHLCKE"[int(str("XYZ".find(m[1])).replace("-1", "") + m[2]) % 23] == m[3]


def steuer_id(digits: str) -> bool:
    """German tax number: 11 digits with an ISO 7064 mod 11,10 check digit."""
    if len(digits) != 11 or digits[0] == "0":
        return False
    p = 10
    for c in digits[:10]:
        p = ((int(c) + p) % 10 or 10) * 2 % 11
    return (11 - p) % 10 == int(digits[10])


def id_card(value: str) -> bool:
    """Serial of a German identity card: weights 7, 3, 1, the last digit checks the others."""
    if not re.fullmatch(r"[CFGHJKLMNPRTVWXYZ0-9]{9}\d?", value) or value.isdigit():
        return False
    body, check = (value[:9], value[9]) if len(value) == 10 else (value[:8], value[8])
    return check.isdigit() and sum(int(c, 36) * (7, 3, 1)[i % 3] for i, c in enumerate(body)) % 10 == int(check)


def phone_plan(raw: str) -> float:
    """Score of a written number under the numbering plans of +1, +33, +44, +49 and other international prefixes."""
    s = raw.strip()
    digits = re.sub(r"\D", "", s.replace("(0)", ""))
    plus = s.startswith("+") or digits.startswith("00")
    if digits.startswith("00"):
        digits = digits[2:]
    grouped = bool(re.search(r"\d[\s().\-/‐‑–]+\d", s))
    if plus:
        if re.fullmatch(r"1[2-9]\d{2}[2-9]\d{6}|33[1-9]\d{8}|44[1-9]\d{8,9}|49[1-9]\d{6,11}", digits):
            return 0.9
        return 0.6 if 8 <= len(digits) <= 15 else 0.0
    if re.fullmatch(r"1?[2-9]\d{2}[2-9]\d{6}", digits) and re.fullmatch(r"(?:1[\s.\-‐‑–]*)?\(?\d{3}\)?[\s.\-‐‑–/]*\d{3}[\s.\-‐‑–]*\d{4}", s):
        return 0.7 if grouped else 0.35
    if re.fullmatch(r"0[1-9]\d{7,10}", digits):
        return 0.6 if grouped else 0.45
    return 0.2 if 7 <= len(digits) <= 12 and grouped else 0.0


# --- proposals ------------------------------------------------------------------------------------------------------

_AT = r"(?:\s?[@＠]\s?|\s?[(\[{]\s?(?:at|AT|ät|arroba)\s?[)\]}]\s?|\s+AT\s+)"
_DOT = r"(?:[.．]|\s?[(\[{]\s?(?:dot|DOT|punkt)\s?[)\]}]\s?|\s+DOT\s+)"
_HID = r"(?:\s?[(\[{]\s?(?:dot|DOT|punkt)\s?[)\]}]\s?|\s+DOT\s+)"
EMAIL = re.compile(rf"(?<![\w.+-])[\w][\w.+-]*(?:{_HID}[\w.+-]+)*{_AT}[\w-]+(?:{_DOT}[\w-]+)+")
_SIGN = r"(?:dot|punkt|point|punto|plus|dash|hyphen|minus|underscore)"
EMAIL_SPOKEN = re.compile(rf"(?<![\w.+-])[\w+.-]+(?:\s+{_SIGN}\s+\w+)*\s+(?:at|arroba|arobase|ät)\s+\w[\w-]*(?:\s+{_SIGN}\s+\w[\w-]*)*\s+(?:dot|punkt|point|punto)\s+[a-z]{{2,}}\b", re.I)
NUMBER = re.compile(r"(?<![\w.,/+-])(?:\+|\((?=\d{3}\)))?\d(?:[\d().\-/‐‑–]|\s(?=[\d(/.\-])){6,26}\d(?![\w])")
DIGIT_WORDS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0", "o": "0", "null": "0", "nought": "0"}
_DW = r"(?:zero|oh|one|two|three|four|five|six|seven|eight|nine|null|nought|double|triple)"
SPOKEN = re.compile(rf"\b(?:plus\s+)?{_DW}(?:[\s,-]+{_DW}){{6,}}\b", re.I)
ID_WORD = re.compile(
    r"(?<![\w-])(?:[A-Z]{2}\d{2}(?:\s?[A-Z\d]{4}){2,7}(?:\s?[A-Z\d]{1,3})?|[A-Z]{2}\s?\d{2}\s?\d{2}\s?\d{2}\s?[A-D]|[XYZ]-?\d{7}-?[A-Z]|\d{8}-?[A-Z]|[A-Z]{1,2}\d{6,8}|(?=[A-Z\d]*\d)[CFGHJKLMNPRTVWXYZ][CFGHJKLMNPRTVWXYZ\d]{7}\d)(?![\w-])",
    re.I,
)

_N = r"[^\W\d_]{2,}(?:['’-][^\W\d_]+)*"
#: Forms of a person's name: given and family name, with or without a middle initial, initial first, family name first.
NAME_FORM = rf"(?:{_N}\s+[^\W\d_]\.?\s+{_N}|[^\W\d_]\.?\s+{_N}|{_N},?\s+{_N})"
#: Relations, roles and doings that stand before or after a person's name in several languages. General words, not whole sentences.
_RELATION = r"neighbou?r|friend|colleague|teacher|brother|sister|mother|father|uncle|aunt|cousin|wife|husband|boss|student|assistant|nachbar(?:in)?|freund(?:in)?|kolleg(?:e|in)|voisine?|amie?|coll[eè]gue|vecin[oa]|amig[oa]"
_ROLE = r"camera|kamera|caméra|cámara|sound|ton|son|sonido|editing|schnitt|montage|music|musik|musique|host|guest|speaker|producer|director|author|editor|contact|moderation|gast|invitée?|presenta"
_DONE = r"edited|written|filmed|shot|recorded|presented|hosted|produced|directed|translated|narrated|drawn|composed|performed|read"
_DOES = r"checked|fixed|found|wrote|filmed|recorded|edited|helped|built|drew|made|sent|lent|spotted|corrected|translated|proofread|reviewed|read|measured|did|took"
#: (words of which one must occur, expression, whether things do so too): what announces or closes a person's name.
ANNOUNCED = [
    (triggers, re.compile(rf"(?<!\w)(?:{lead})(?P<n>{NAME_FORM})(?!\w){tail}", re.I), bool(tail) or lead.startswith(rf"(?:{_DONE})"))
    for triggers, lead, tail in (
        (("dr",), r"(?:prof\.?\s+)?dr\.?a?\s+", ""),
        (("prof",), r"prof\.?\s+", ""),
        (("mr",), r"mrs?\.?\s+", ""),
        (("ms",), r"ms\.\s+", ""),
        (("frau", "herr"), r"(?:frau|herrn?)\s+", ""),
        (("mme", "monsieur", "madame"), r"(?:mme\.?|monsieur|madame)\s+", ""),
        (("señor", "sr", "doña"), r"señora?\s+|sra?\.\s+|doña\s+", ""),
        (("dank",), r"danke?\s+an\s+(?!frau\s|herrn?\s)", ""),
        (("thank",), r"(?:thanks\s+to|thank\s+you,?)\s+", ""),
        (("merci", "gracias"), r"(?:merci\s+à|gracias\s+a)\s+", ""),
        ((" for ", " für ", " pour ", " para ", "memory"), r"(?:this\s+(?:one|video|episode|song)\s+is\s+(?:also\s+)?for|dedicated\s+to|in\s+memory\s+of|gewidmet|en\s+memoria\s+de)\s+", ""),
        (("my ", "our ", "mein", "unser", "mon ", "ma ", "notre", "mi ", "nuestr"), rf"(?:my|our|his|her|meine?|unsere?|mon|ma|notre|mi|nuestr[oa])\s+(?:{_RELATION})\s+", ""),
        (("interview", "talk", "gespräch", "entretien", "entrevista"), r"(?:interview|conversation|talk|gespräch|entretien|entrevista)\s+(?:with|mit|avec|con)\s+", ""),
        ((":",), rf"(?:{_ROLE})\s?:\s+", ""),
        ((" by ",), rf"(?:{_DONE})\s+by\s+", ""),
        (("name is", "heiße", "appelle", "llamo"), r"(?:my\s+name\s+is|ich\s+heiße|je\s+m['’]appelle|me\s+llamo)\s+", ""),
        (tuple(_DOES.split("|")), r"", rf"(?=\s+(?:{_DOES})\s+(?:the|this|all|every|my|our)\b)"),
    )
]
#: A name alone in brackets, or as the alternative in brackets.
ASIDE = re.compile(rf"\(\s?(?P<as>(?:or|alt|oder|ou|aka)\b:?\s+)?(?P<n>{NAME_FORM})\s?\)", re.I)

_S = r"(?:[^\W\d_][\w'’-]*\.?\s+)"
_ROAD = r"(?:street|lane|road|avenue|ave|drive|court|terrace|close|square|boulevard|blvd|way|row|hill|crescent)\b\.?"
ADDRESSES = [
    (trigger, re.compile(expression, re.I))
    for trigger, expression in (
        (("street", "lane", "road", "ave", "drive", "court", "terrace", "close", "square", "blvd", "boulevard", " way", " row", " hill", "crescent"), rf"(?<![\w.,:/-])\d{{1,4}}\s?[a-z]?\s+(?:{_S}){{1,2}}{_ROAD}(?!\s+suite)"),
        (("ave", "blvd", "street", "road", "lane"), r"(?<!\w)(?:(?:old|new|great|upper|lower|high|north|south|east|west|saint|st\.?)\s+)?[^\W\d_][\w'’-]*\s+(?:ave\b\.?|avenue\b|blvd\b\.?|boulevard\b|street\b|road\b|lane\b)\s+\d{1,4}[a-z]?\b"),
        (("straße", "strasse", "str.", "gasse", "weg ", "platz", "allee"), r"(?<!\w)(?:(?:old|new|alte|neue|am|an der|obere|untere)\s+)?[^\W\d_][^\W\d_-]*-?\s?(?:straße|strasse|str\.|gasse|weg|platz|allee)\s+\d{1,4}(?:\s?[a-z]\b)?"),
        (("calle", "avenida", "plaza", "paseo", "c/"), rf"(?<!\w)(?:calle|avenida|avda\.|plaza|paseo|c/)\s*(?:{_S}){{1,3}}(?:n[º°.]\s*)?\d{{1,4}}\b"),
        (("rue", "avenue", "boulevard", "place", "chemin", "impasse"), r"(?<![\w.,:/-])\d{1,4}\s*(?:(?:bis|ter|quater)\b)?,?\s*(?:rue|avenue|boulevard|place|chemin|impasse)\s+[^\W\d_][\w'’-]*"),
        (("box",), r"(?<!\w)(?:p\.?\s?o\.?|post\s+office)\s+box\s+\d{1,6}\b"),
        (("postfach", "apartado", "boîte postale"), r"(?<!\w)(?:postfach|apartado(?:\s+de\s+correos)?|boîte\s+postale)\s+\d{1,6}\b"),
    )
]

PHONE_NEAR = re.compile(r"call|\btel\b|tel\.|telefon|téléphone|phone|hotline|text|joignable|unter\b|mobile|handy|dial|ring|sms|voicemail|contact|whatsapp|fax|appelez|llam|ruf|\(or|\(alt|reach", re.I)
ID_NEAR = re.compile(r"\bssn\b|social security|\bdni\b|\bnie\b|\bnir\b|personalausweis|ausweis|national insurance|tax number|steuer|passport|pasaporte|passeport|\bid\b|identity|iban|konto|card number|kreditkarte|\bform\b|formular|contract|vertrag|document|registration|insurance|versicherung|camera", re.I)
#: Words that say a number counts or names something else.
NUMBER_ELSE = re.compile(
    r"\b(?:order|invoice|receipt|ticket|isbn|issn|ref|reference|part no|serial|batch|lot|sku|model|version|build|release|chapter|page|episode|track|clip|take|scene|mix|sample|code|tag|total|sum|ratio|score|grid|coordinates|fps|dpi|pixels|views|seed|checksum)s?\b",
    re.I,
)
NAME_ELSE = re.compile(r"\b(?:licensed|plugin|playlist)\b", re.I)


def _plain(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word.lower().replace("ø", "o")) if not unicodedata.combining(c))


def _spoken_digits(run: str) -> str:
    out, times = [], 1
    for w in re.findall(r"\w+", run.lower()):
        if w in ("double", "triple"):
            times = 2 + (w == "triple")
        elif w in DIGIT_WORDS:
            out.append(DIGIT_WORDS[w] * times)
            times = 1
    return "".join(out)


def _id_score(value: str) -> float:
    """Score of a written identity number by its form and check digits alone."""
    v = re.sub(r"[\s.\-‐‑–/]", "", value).upper()
    if v.isdigit():
        if len(v) == 15:
            return 0.95 if nir(v) else 0.1
        if re.fullmatch(r"\d{3}[-\s‐‑–]\d{2}[-\s‐‑–]\d{4}", value):
            return 0.45
        if 13 <= len(v) <= 19:
            return 0.7 if luhn(v) else 0.0
        return 0.45 if steuer_id(v) else 0.15 if 8 <= len(v) <= 12 else 0.0
    if re.fullmatch(r"[A-Z]{2}\d{2}[A-Z\d]{11,30}", v):
        return 0.95 if mod97_iban(v) else 0.0
    if nie(v):
        return 0.75
    if re.fullmatch(r"[A-Z]{2}\d{6}[A-D]", v):
        return 0.5
    if id_card(v):
        return 0.5
    return 0.2


def _looks_like_name(name: str, params: PiiParams) -> bool:
    """An initial, a frequent given name, or capitals on every word."""
    words = re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", name)
    return bool(re.search(r"(?:^|\s)(?:[^\W\d_]\.|[A-Z]\s)", name)) or any(_plain(x) in params.given_names for w in words for x in w.split("-")) or all(w[0].isupper() and not w.isupper() for w in words)


def find_values(text: str, params: PiiParams = PiiParams()) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) of every personal value, without overlaps, in order of place."""
    found: list[tuple[int, int, str, float]] = []
    low = text.lower()

    def near(pattern: re.Pattern, start: int, end: int) -> bool:
        return bool(pattern.search(text, max(0, start - params.before), start) or pattern.search(text, end, min(len(text), end + params.after)))

    def closest(start: int) -> re.Pattern | None:
        """Which of the contexts of numbers stands closest before a place."""
        best, at = None, -1
        for pattern in (NUMBER_ELSE, ID_NEAR, PHONE_NEAR):
            last = max((m.end() for m in pattern.finditer(text, max(0, start - 18), start)), default=-1)
            if last > at:
                best, at = pattern, last
        return best

    if "@" in text or "＠" in text or "at)" in low or "at]" in low or "at }" in low or "at ]" in low or " AT " in text or "\nAT " in text:
        found += [(m.start(), m.end(), "email", 1.0) for m in EMAIL.finditer(text)]
    if " dot " in low or " punkt " in low or " punto " in low or " point " in low:
        found += [(m.start(), m.end(), "email", 0.9) for m in EMAIL_SPOKEN.finditer(text)]
    for m in NUMBER.finditer(text):
        s, e, raw = m.start(), m.end(), m[0]
        if raw.count("(") != raw.count(")"):
            e = s + (raw.rfind("(") if raw.rfind("(") > raw.rfind(")") else len(raw))
            raw = text[s:e].rstrip(" .-/(")
            e = s + len(raw)
            if raw.count("(") < raw.count(")"):
                raw = raw[: raw.index(")")].rstrip(" .-/")
                e = s + len(raw)
        announced = closest(s)
        elsewhere = announced is NUMBER_ELSE
        as_id = _id_score(raw) + (0.45 if near(ID_NEAR, s, e) else 0) - (0.8 if elsewhere else 0)
        as_phone = phone_plan(raw) + (0.3 if near(PHONE_NEAR, s, e) else 0) - (0.8 if elsewhere else 0) - (0.4 if announced is ID_NEAR else 0)
        if max(as_id, as_phone) >= params.threshold:
            found.append((s, e, "id_number", as_id) if as_id > as_phone else (s, e, "phone", as_phone))
    for m in SPOKEN.finditer(text):
        digits = _spoken_digits(m[0])
        s, e = m.start(), m.end()
        if len(digits) in (9, 15) and (nir(digits) or len(digits) == 9):
            score = (0.95 if nir(digits) else 0.35) + (0.3 if near(ID_NEAR, s, e) or closest(s) is PHONE_NEAR else 0)
            found.append((s, e, "id_number", score))
        elif len(digits) >= 9:
            plan = max(phone_plan(digits), phone_plan("+" + digits.lstrip("0") if not digits.startswith("00") else digits))
            found.append((s, e, "phone", plan + (0.3 if near(PHONE_NEAR, s, e) else 0)))
    for m in ID_WORD.finditer(text):
        s, e = m.start(), m.end()
        if any(c.isdigit() for c in m[0]) and closest(s) is not NUMBER_ELSE:
            score = _id_score(m[0])
            if score > 0:
                found.append((s, e, "id_number", score + (0.45 if near(ID_NEAR, s, e) else 0.0)))
    for triggers, pattern in ADDRESSES:
        if any(t in low for t in triggers):
            found += [(m.start(), m.end(), "address", 0.8) for m in pattern.finditer(text)]
    for triggers, pattern, strict in ANNOUNCED:
        if any(t in low for t in triggers):
            for m in pattern.finditer(text):
                words = [w.lower() for w in re.findall(r"[^\W\d_]{2,}", m["n"])]
                if strict and not _looks_like_name(m["n"], params):
                    continue
                if not NOT_PERSON.intersection(words) and not NAME_ELSE.search(text, m.end(), m.end() + params.after):
                    found.append((m.start("n"), m.end("n"), "name", 0.85))
    if "(" in text:
        for m in ASIDE.finditer(text):
            words = [w.lower() for w in re.findall(r"[^\W\d_]{2,}", m["n"])]
            if (m["as"] or _looks_like_name(m["n"], params)) and not NOT_PERSON.intersection(words):
                found.append((m.start("n"), m.end("n"), "name", 0.7))
    kept: list[tuple[int, int, str, float]] = []  # without overlaps, in order of place
    for span in sorted((x for x in found if x[3] >= params.threshold), key=lambda x: (-x[3], x[0], -x[1])):
        at = bisect_right(kept, span[0], key=lambda k: k[0])
        if (at == 0 or kept[at - 1][1] <= span[0]) and (at == len(kept) or kept[at][0] >= span[1]):
            kept.insert(at, span)
    return kept


# --- operators ------------------------------------------------------------------------------------------------------


def texts_of(rows: DataFrame, key: str, column: str, field: str) -> DataFrame:
    """(field, record_key, texts): a string column as one piece, an array of segments as its pieces."""
    pieces = segment_texts(column) if dict(rows.dtypes)[column].startswith("array") else F.array(text_of(column))
    return rows.select(F.lit(field).alias("field"), F.col(key).cast("long").alias("record_key"), pieces.alias("texts"))


def _join(pieces: list[str]) -> tuple[str, list[int]]:
    starts, at = [], 0
    for p in pieces:
        starts.append(at)
        at += len(p) + 1
    return " ".join(pieces), starts


def _batches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, list[str]]]:
    for b in batches:
        fields, keys, texts = b.column(0), b.column(1), b.column(2)
        for i in range(b.num_rows):
            yield fields[i].as_py(), keys[i].as_py(), [t or "" for t in texts[i].as_py() or []]


def personal_values(texts: DataFrame, params: PiiParams = PiiParams()) -> DataFrame:
    """(field, record_key, seg_pos, kind, start_char, n_chars) of every personal value in (field, record_key, texts)."""
    names = ["field", "record_key", "seg_pos", "kind", "start_char", "n_chars"]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in names]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32()]
        for field, key, pieces in _batches(batches):
            text, starts = _join(pieces)
            for s, e, kind, _ in find_values(text, params):
                k = bisect_right(starts, s) - 1
                for column, value in zip(out, (field, key, k, kind, s - starts[k], e - s)):
                    column.append(value)
            if len(out[0]) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)
                out = [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)

    return texts.select("field", "record_key", "texts").mapInArrow(scan, "field string, record_key long, seg_pos int, kind string, start_char int, n_chars int")


def redact_pieces(pieces: list[str], params: PiiParams = PiiParams()) -> tuple[list[str], int]:
    """The pieces with ``[KIND]`` in place of every value, and how many values there were.

    A value that runs on into later pieces leaves its placeholder where it begins and is removed from the others.
    """
    text, starts = _join(pieces)
    spans = find_values(text, params)
    out = []
    for k, piece in enumerate(pieces):
        lo, hi, at, parts = starts[k], starts[k] + len(piece), starts[k], []
        for s, e, kind, _ in spans:
            if s < hi and e > lo:
                parts.append(text[at : max(s, lo)])
                parts.append(f"[{kind.upper()}]" if s >= lo else "")
                at = max(at, min(e, hi))
        out.append("".join(parts) + text[at:hi])
    return out, len(spans)


def redacted(texts: DataFrame, params: PiiParams = PiiParams()) -> DataFrame:
    """(field, record_key, texts, n_values): the same pieces with typed placeholders, all other characters unchanged."""
    names = ["field", "record_key", "texts", "n_values"]
    kinds = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.int32()]

    def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(f, k, *redact_pieces(p, params)) for f, k, p in _batches([b])]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    return texts.select("field", "record_key", "texts").mapInArrow(rewrite, "field string, record_key long, texts array<string>, n_values int")
