"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Two first-order models over character classes with smoothing are trained from labelled samples: random strings drawn
from the alphabets that keys use, and ordinary identifiers, words and numbers. Every token of key characters is scored,
whatever its length and whatever stands before it. It is reported when the log-likelihood ratio of random over ordinary is above
``MARGIN`` in total; else those of its parts between separators are that hold a stretch above ``MARGIN``. A pair of characters
that a token has had before speaks for nothing, so runs and patterns that repeat are not random.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

# The base patterns, the least lengths of their matches, and the kinds in their order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST = 8
KINDS = ("assign", "access", "hex", "random")

PADDING = re.compile(r"={1,2}(?![A-Za-z0-9+/_=-])")
SEPARATORS = "/_-"
MARGIN = 12.0
MASK = "[SECRET]"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-="

# Ordinary identifiers, words and numbers, label 0 of the training samples.
ORDINARY = """
get_user_by_identifier set_default_configuration connection_pool_timeout maximum_retry_attempts is_authenticated_user
calculateTotalAmount HttpRequestHandlerFactory AbstractSingletonBean initializeDatabaseConnection parseJsonDocument
XMLHttpRequestEventTarget IllegalArgumentException customerShippingAddress_line_2 order_items_2024_backup
application/x-www-form-urlencoded text/html content-security-policy x-forwarded-for if-none-match-header-value
var/log/application/server/error usr/local/lib/python/site-packages src/main/java/org/example/service/impl
MAX_BUFFER_SIZE_BYTES DEFAULT_SOCKET_TIMEOUT ENVIRONMENT_VARIABLE_NAME HTTP_STATUS_NOT_FOUND version_10_release_3
2024-01-15 2023-12-31-23-59-59 12_345_678_901 98765_43210_13579_24680e+10 31415_92653_58979_32384e-7 10000000000000000000 00000000000000000000 1234567890 4111-1111-1111-1111 192-168-100-200
internationalization incomprehensibilities counterrevolutionary uncharacteristically electroencephalograph
Donaudampfschifffahrtsgesellschaft Geschwindigkeitsbegrenzung Rechtsschutzversicherungsgesellschaften Aufmerksamkeit
anticonstitutionnellement professionnellement electroencefalografista desafortunadamente responsabilidades
the quick brown fox jumps over lazy dog and then some other words that people write in sentences every day
----------------------- ======================= ______________________ -----BEGIN-----END----- aaaaaaaaaaaaaaaaaaaaaaaa
ththshanered onthering eaerlyones tionandesheinthe oresandthewhthe ingionedreatti ndererentithaon hehaouinesly
section-three-introduction chapter-seven-conclusion how-to-install-and-configure-the-package frequently-asked-questions
""".split()

# More words of label 0, learnt in lower case, with a capital, and in capitals.
PROSE = """
because although people would never think about themselves without knowledge of history question language through between
government different example children together important business company thousand against another morning evening yesterday
strength rhythm eighth twelfth window yellow quickly quarter equal exactly expect extra maximum jump object project subject just
water weather father mother brother under over after always number system program machine value table paper school student house
meanwhile overwhelm everywhere somewhere somewhat nonwhite answer worthless disgusting pathetic street building country village mountain river ocean island bridge market kitchen garden bottle
javascript postgresql youtube facebook wikipedia microsoft google android iphone linux windows kubernetes github readme todo json html
ein eine einen einer nicht werden wurde zwischen durch schon immer wieder gegen natuerlich verschiedene moeglichkeit entwicklung zukunft
geschichte gesellschaft wirtschaft wissenschaft schule strasse haus kinder jahre woche arbeit zeit ueber unter pfennig zwanzig zurueck
zusammen zug zeitung bewegung beziehung freiheit wahrheit gesundheit einheit gelegenheit schwierigkeiten taetigkeit ausschuss fluss
aufgabe ausgabe angst kampf kopf apfel pferd pflanze katze platz satz herz ganz jetzt nichts sprache sprechen schreiben schlafen
toujours beaucoup pourquoi parce aujourd maintenant question quelque chaque lorsque puisque jusque heureux malheureusement mieux vieux
deux yeux ceux eux lieux eaux oiseau bateau chateau beau nouveau roi loi moi toi trois voix choix froid endroit avoir savoir pouvoir
vouloir devoir croire voiture famille fille travail soleil oeil oui louer jouer ailleurs faire maire affaire necessaire elle celle belle
nouvelle ville mille question attention nation solution gouvernement mouvement appartement notre votre autre entre montre fenetre
siempre nunca todavia porque cuando donde quien aunque mientras despues antes ahora entonces tambien mucho poco algunos algunas
ciudad verdad libertad universidad trabajo hijo hija lejos mejor mujer bajo abajo caja hoja ojo rojo viejo llamar llegar llevar calle
ella ellos aquella guerra tierra perro correr arriba luego juego fuego pueblo bueno nuevo huevo puerta fuerte muerte veces voz luz paz
feliz vez diez cabeza corazon rodriguez gonzalez lopez martinez perez pasado estado mercado dado lado cuidado abogado amigo amiga
""".split()


def ordinary_samples() -> list[str]:
    """Label 0 of the training samples: ``ORDINARY``, ``PROSE`` in three cases, and digits drawn evenly from a fixed seed, as in card numbers."""
    rng = np.random.default_rng(12)
    numbers = ["".join(rng.choice(list("0123456789"), size=16)) for _ in range(60)]
    return [*ORDINARY, *numbers, *(form for word in PROSE for form in (word, word.capitalize(), word.upper())), ALPHABET[:26], ALPHABET[26:52]]


def random_samples(count: int = 2000) -> list[str]:
    """Label 1 of the training samples: strings drawn evenly from the alphabets of keys, from a fixed seed."""
    rng = np.random.default_rng(11)
    alphabets = ("0123456789abcdef", "0123456789ABCDEF", ALPHABET[:62], ALPHABET[:64], ALPHABET[26:62], ALPHABET[:62] + "_-")
    return ["".join(rng.choice(list(alphabets[i % len(alphabets)]), size=40)) for i in range(count)]


def train_model(samples: list[str], weight: float) -> np.ndarray:
    """Log-probabilities of the next character; row ``len(ALPHABET)`` is the start. ``weight`` spreads over unseen pairs."""
    place = {c: i for i, c in enumerate(ALPHABET)}
    counts = np.full((len(ALPHABET) + 1, len(ALPHABET)), weight / len(ALPHABET))
    for sample in samples:
        before = len(ALPHABET)
        for c in sample:
            if c in place:
                counts[before, place[c]] += 1
                before = place[c]
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def ratio_table(random: list[str] | None = None, ordinary: list[str] | None = None) -> np.ndarray:
    """Log-likelihood ratio of each step, random over ordinary."""
    return train_model(random or random_samples(), 8.0) - train_model(ordinary or ordinary_samples(), 2.0)


_PLACE = np.full(128, -1, dtype=np.int64)
_PLACE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
START = len(ALPHABET)
_KEY_CODE = np.full(129, -1, dtype=np.int64)
_KEY_CODE[:128] = np.where(np.arange(128) == ord("="), -1, _PLACE)


def randomness(token: str, table: np.ndarray) -> float:
    """The log-likelihood ratio of a token of ``ALPHABET`` characters."""
    codes = _PLACE[np.frombuffer(token.encode("ascii"), dtype=np.uint8)]
    return float(table[np.append(len(ALPHABET), codes[:-1]), codes].sum())


def _tokens(text: str, table: np.ndarray, margin: float) -> Iterator[tuple[int, int]]:
    """The tokens that have a stretch above ``margin`` when repeated pairs count like others, all of them at once."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = _KEY_CODE[np.minimum(points, 128)]
    at = np.flatnonzero(codes >= 0)
    if not len(at):
        return
    codes = codes[at]
    first = np.append(True, np.diff(at) > 1)
    steps = table[np.where(first, START, np.append(START, codes[:-1])), codes]
    sums = np.cumsum(steps)
    opened, token = table[START, codes] - sums, np.cumsum(first)
    reach = np.ptp(opened) + 1  # lifts each token's values above all before it, so one running maximum serves all tokens
    best = sums + np.maximum.accumulate(opened + token * reach) - token * reach
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(at)) - 1
    for i in np.flatnonzero(np.maximum.reduceat(best, starts) > margin - 0.01):
        yield int(at[starts[i]]), int(at[ends[i]]) + 1


def _stretches(token: str, table: np.ndarray, margin: float) -> Iterator[tuple[int, int]]:
    """Stretches whose ratio is above ``margin``, each up to its highest sum; it ends where the sum is used up or ``margin`` below that."""
    codes = _PLACE[np.frombuffer(token.encode("ascii"), dtype=np.uint8)]
    steps = table[np.append(START, codes[:-1]), codes]
    pairs = np.append(-1, codes[:-1] * START + codes[1:])
    again = np.ones(len(codes), dtype=bool)
    again[np.unique(pairs, return_index=True)[1]] = False
    steps, opening = np.where(again, np.minimum(steps, 0.0), steps).tolist(), table[START, codes].tolist()
    i = begin = end = 0
    total = top = 0.0
    while i < len(steps):
        if total > 0:
            total += steps[i]
        else:
            total, begin, top = opening[i], i, 0.0
        i += 1
        if total > top:
            top, end = total, i
        if top > margin and (total <= max(0.0, top - margin) or i == len(steps)):
            yield begin, end
            i, total, top = end, 0.0, 0.0


def random_parts(token: str, table: np.ndarray, margin: float = MARGIN) -> list[tuple[int, int]]:
    """The token as a whole if all of it is above ``margin``, else its parts between separators that hold such a stretch."""
    found: list[tuple[int, int]] = []
    for begin, end in _stretches(token, table, margin):
        if randomness(token, table) > margin:
            return [(0, len(token))]
        while begin and token[begin - 1] not in SEPARATORS:
            begin -= 1
        while end < len(token) and token[end] not in SEPARATORS:
            end += 1
        if found and begin <= found[-1][1]:
            found[-1] = (found[-1][0], max(end, found[-1][1]))
        else:
            found.append((begin, end))
    return found


def find_spans(text: str | None, table: np.ndarray, margin: float = MARGIN) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in code points, by start and then kind as listed."""
    text = text or ""
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    for start, end in _tokens(text, table, margin):
        for a, b in random_parts(text[start:end], table, margin):
            padding = PADDING.match(text, end) if start + b == end else None
            spans.append((start + a, padding.end() if padding else start + b, "random"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def mask_spans(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every run of overlapping spans replaced by one mark."""
    parts, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], MASK]
            at = end
        else:
            at = max(at, end)
    return "".join(parts) + text[at:]


FOUND = StructType([StructField(f"n_{k}", LongType()) for k in KINDS[:3]] + [StructField("base_sha256", StringType()), StructField("spans", StringType())])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    A null text counts as empty and has no spans; the digest is then that of an empty string. Repeated ids each get a
    row. No rows give no rows.
    """
    table = ratio_table()

    @F.pandas_udf(FOUND)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                spans = find_spans(text, table, margin)
                base = [s for s in spans if s[2] != "random"]
                counts = [sum(s[2] == kind for s in base) for kind in KINDS[:3]]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            yield pd.DataFrame(rows, columns=FOUND.names)

    return docs.select(F.col(id_col).alias("doc_id"), found(F.col(text_col).cast("string")).alias("found")).select("doc_id", "found.*")


def redacted(text: Column, margin: float = MARGIN) -> Column:
    """The text with its secrets masked; texts without any, and nulls, stay as they are."""
    table = ratio_table()

    @F.pandas_udf(StringType())
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([None if t is None else mask_spans(t, find_spans(t, table, margin)) for t in texts], dtype=object)

    return mask(text)
