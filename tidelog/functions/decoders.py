"""Decoders of native column bytes, from the published formats.

The plain functions work on one value; ``udf`` wraps one as a Pandas UDF over a binary column.
NUMBER is base 100 with an exponent of excess 64; DATE and TIMESTAMP are excess-100 century
bytes; binary floats are IEEE numbers with their sign bit turned so that bytes sort.
"""

from __future__ import annotations

import datetime as dt
import gzip
import struct
from collections.abc import Callable
from decimal import Context, Decimal
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = Context(prec=60)


def number(b: bytes) -> Decimal | None:
    """NUMBER to an exact decimal; no bytes are NULL."""
    if not b:
        return None
    if b == b"\x80":
        return Decimal(0)
    if b == b"\xff\x65":
        return Decimal("Infinity")
    if b == b"\x00":
        return Decimal("-Infinity")
    positive = b[0] & 0x80
    exponent = (b[0] & 0x7F if positive else ~b[0] & 0x7F) - 65
    digits = list(b[1:])
    if not positive:
        if digits and digits[-1] == 102:
            digits.pop()
        pairs = [101 - d for d in digits]
    else:
        pairs = [d - 1 for d in digits]
    if not pairs or any(not 0 <= p <= 99 for p in pairs):
        raise ValueError(f"not a NUMBER: {b.hex()}")
    whole = Decimal(int("".join(f"{p:02d}" for p in pairs)))
    value = whole.scaleb(2 * (exponent - len(pairs) + 1), _EXACT)
    return value if positive else value.copy_negate()


def number_bytes(value: Decimal | int) -> bytes:
    """An exact decimal to NUMBER."""
    d = Decimal(value)
    if not d:
        return b"\x80"
    sign, digits, exp = d.as_tuple()
    text = "".join(map(str, digits))
    if exp % 2:
        text, exp = text + "0", exp - 1
    if len(text) % 2:
        text = "0" + text
    pairs = [int(text[k : k + 2]) for k in range(0, len(text), 2)]
    power = exp // 2 + len(pairs) - 1
    while pairs and pairs[0] == 0:
        pairs.pop(0)
        power -= 1
    while pairs[-1] == 0:
        pairs.pop()
    head = 193 + power
    if sign:
        return bytes([~head & 0xFF, *(101 - p for p in pairs)]) + (b"\x66" if len(pairs) < 20 else b"")
    return bytes([head, *(p + 1 for p in pairs)])


def binary_float(b: bytes) -> float | None:
    if not b:
        return None
    return struct.unpack(">f", bytes([b[0] & 0x7F, *b[1:]]) if b[0] & 0x80 else bytes(x ^ 0xFF for x in b))[0]


def binary_double(b: bytes) -> float | None:
    if not b:
        return None
    return struct.unpack(">d", bytes([b[0] & 0x7F, *b[1:]]) if b[0] & 0x80 else bytes(x ^ 0xFF for x in b))[0]


def timestamp(b: bytes) -> dt.datetime | None:
    """DATE (7 bytes) or TIMESTAMP (11, with nanoseconds, kept to microseconds); one byte or none is NULL."""
    if len(b) < 7:
        return None
    year = (b[0] - 100) * 100 + b[1] - 100
    micro = int.from_bytes(b[7:11], "big") // 1000 if len(b) >= 11 else 0
    return dt.datetime(year, b[2], b[3], b[4] - 1, b[5] - 1, b[6] - 1, micro)


def timestamp_tz(b: bytes, database_zone: str = "+00:00") -> str | None:
    """TIMESTAMP WITH (LOCAL) TIME ZONE to ISO-8601; stored in UTC, with an offset of excess 20 hours and 60 minutes."""
    t = timestamp(b[:11])
    if t is None:
        return None
    if len(b) < 13:
        return t.isoformat() + database_zone
    if b[11] & 0x80:
        raise ValueError("named zones need the database's zone table")
    shift = dt.timedelta(hours=b[11] - 20, minutes=b[12] - 60)
    return t.replace(tzinfo=dt.UTC).astimezone(dt.timezone(shift)).isoformat()


def interval(b: bytes) -> str | None:
    """INTERVAL YEAR TO MONTH (5 bytes) or DAY TO SECOND (11) to ISO-8601."""
    if not b:
        return None
    head = int.from_bytes(b[:4], "big") - 0x80000000
    if len(b) == 5:
        values = [(head, "Y"), (b[4] - 60, "M")]
        sign = "-" if head < 0 or values[1][0] < 0 else ""
        body = "".join(f"{abs(v)}{u}" for v, u in values if v)
        return f"{sign}P{body or '0M'}"
    if len(b) != 11:
        raise ValueError(f"not an INTERVAL: {b.hex()}")
    h, m, s = (x - 60 for x in b[4:7])
    nano = int.from_bytes(b[7:11], "big") - 0x80000000
    sign = "-" if min(head, h, m, s, nano) < 0 else ""
    second = f"{abs(s)}" + (f".{abs(nano):09d}".rstrip("0") if nano else "")
    time = "".join(x for x, v in ((f"{abs(h)}H", h), (f"{abs(m)}M", m), (f"{second}S", s or nano)) if v)
    day = f"{abs(head)}D" if head else ""
    return f"{sign}P{day}" + (f"T{time}" if time else "" if day else "T0S")


def boolean(b: bytes) -> bool | None:
    if not b:
        return None
    if b in (b"\x00", b"\x01"):
        return b == b"\x01"
    raise ValueError(f"not a BOOLEAN: {b.hex()}")


#: Database character set to codec where the names differ (fixed values).
CHARSETS = {
    "AL32UTF8": "utf-8", "UTF8": "utf-8", "AL16UTF16": "utf-16-be", "US7ASCII": "ascii", "WE8ISO8859P1": "iso8859-1", "WE8ISO8859P15": "iso8859-15",
    "EE8ISO8859P2": "iso8859-2", "CL8ISO8859P5": "iso8859-5", "EL8ISO8859P7": "iso8859-7", "WE8MSWIN1252": "cp1252", "EE8MSWIN1250": "cp1250", "CL8MSWIN1251": "cp1251",
    "EL8MSWIN1253": "cp1253", "TR8MSWIN1254": "cp1254", "IW8MSWIN1255": "cp1255", "AR8MSWIN1256": "cp1256", "BLT8MSWIN1257": "cp1257", "VN8MSWIN1258": "cp1258",
    "CL8KOI8R": "koi8-r", "CL8KOI8U": "koi8-u", "JA16SJIS": "shift_jis", "JA16EUC": "euc_jp", "KO16KSC5601": "euc_kr", "KO16MSWIN949": "cp949",
    "ZHS16GBK": "gbk", "ZHS16CGB231280": "gb2312", "ZHS32GB18030": "gb18030", "ZHT16BIG5": "big5", "ZHT16MSWIN950": "cp950", "TH8TISASCII": "tis-620",
}


def text(b: bytes, charset: str = "AL32UTF8") -> str | None:
    if charset not in CHARSETS:
        raise ValueError(f"unsupported character set {charset}")
    return b.decode(CHARSETS[charset]) if b else None


def xml(b: bytes, is_clob: bool = False) -> str:
    return b.decode("utf-16-be" if is_clob else "utf-8")


def vector(b: bytes) -> dict[str, list] | None:
    """VECTOR to a struct with one of F (32-bit), D (64-bit), I (8-bit) or B (bits).

    Header: magic DB, version, flags (2 bytes), element type, dimensions (4); a norm of 8 bytes follows where flags have 0x2.
    """
    if not b:
        return None
    if b[0] != 0xDB:
        raise ValueError("not a VECTOR")
    flags, kind, n = int.from_bytes(b[2:4], "big"), b[4], int.from_bytes(b[5:9], "big")
    at = 9 + 8 * bool(flags & 0x12)
    if kind == 2:
        return {"F": [binary_float(b[at + 4 * k : at + 4 * k + 4]) for k in range(n)]}
    if kind == 3:
        return {"D": [binary_double(b[at + 8 * k : at + 8 * k + 8]) for k in range(n)]}
    if kind == 4:
        return {"I": list(struct.unpack(f">{n}b", b[at : at + n]))}
    if kind == 5:
        return {"B": [bool(b[at + k // 8] >> (7 - k % 8) & 1) for k in range(n)]}
    raise ValueError(f"unknown VECTOR element type {kind}")


def gunzip(b: bytes) -> str | None:
    """Compressed text, or plain bytes without the magic number."""
    if b is None:
        return None
    return gzip.decompress(b).decode() if b[:2] == b"\x1f\x8b" else b.decode()


def decrypt_column(data: bytes, key: bytes, salted: bool = True, integrity: int = 20) -> bytes:
    """A TDE column value (AES-CBC): [ciphertext][16 bytes IV if salted][20 bytes SHA-1 or none]; padding goes."""
    try:
        from cryptography.hazmat.primitives.ciphers import Cipher, algorithms, modes
    except ImportError as e:
        raise NotImplementedError("the cryptography package is needed; for CBC and GCM without it use aes_decrypt in SQL") from e
    body = data[: len(data) - integrity] if integrity else data
    iv, body = (body[-16:], body[:-16]) if salted else (bytes(16), body)
    d = Cipher(algorithms.AES(key), modes.CBC(iv)).decryptor()
    plain = d.update(body) + d.finalize()
    return plain[: -plain[-1]]


def decrypted(column: Column, key: Column, salted: bool = True, integrity: int = 20) -> Column:
    """The same inside the JVM, as a plain expression."""
    size = F.length(column)
    body = F.substring(column, F.lit(1), size - integrity)
    iv = F.substring(column, size - integrity - 15, F.lit(16)) if salted else F.lit(bytes(16))
    cipher = F.substring(body, F.lit(1), F.length(body) - 16) if salted else body
    return F.aes_decrypt(F.concat(iv, cipher), key, F.lit("CBC"), F.lit("PKCS"))


def udf(fn: Callable[[bytes], Any], kind: str, strict: bool = True) -> Callable[[Column], Column]:
    """A decoder over a binary column; without ``strict`` (nullable columns) bad bytes give NULL."""

    def one(b: bytes | None) -> Any:
        if b is None:
            return None
        try:
            return fn(bytes(b))
        except (ValueError, IndexError, UnicodeDecodeError):
            if strict:
                raise
            return None

    @F.pandas_udf(kind)
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([one(b) for b in s], index=s.index, dtype=object)

    return run


def udf_of_values(fn: Callable[[Any], Any], kind: str) -> Callable[[Column], Column]:
    """A plain function over the values of a column as a Pandas UDF; NULL stays."""

    @F.pandas_udf(kind)
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(v) else fn(v) for v in s], index=s.index, dtype=object)

    return run


def ora_date(column: Column) -> Column:
    """DATE bytes as a timestamp without zone, inside the JVM."""
    byte = lambda k: F.conv(F.hex(F.substring(column, F.lit(k), F.lit(1))), 16, 10).cast("int")
    return F.when(F.length(column) >= 7, F.make_timestamp_ntz((byte(1) - 100) * 100 + byte(2) - 100, byte(3), byte(4), byte(5) - 1, byte(6) - 1, (byte(7) - 1).cast("decimal(16,6)")))
