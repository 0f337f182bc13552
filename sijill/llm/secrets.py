"""Secret scan: patterns, and strings that zstandard finds novel.

Method: a candidate is a long run of key characters shortly after a word that speaks of
credentials. Its novelty is the number of bytes by which it lengthens the compressed form of
the text around it, where the compressor is primed with a dictionary of common identifiers
and that text. What stays incompressible, and mixes letters and digits, is reported.

Null and empty texts have no spans. Repeated rows each give a row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame

from .common import kept, small_batches, texts

# The patterns of the base kinds.
ASSIGN = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

# Words that make a context sensitive.
SENSITIVE = ("password", "passwd", "secret", "token", "apikey", "api_key", "api-key", "credential",
             "authorization", "bearer", "private_key", "private key", "access_key", "client_id", "signature", "akia")

# Identifiers and code that prime the compressor.
IDENTIFIERS = """
import os sys json time datetime logging config settings environment database connection
username password passwd secret token api_key apikey access_key secret_key private_key public_key
authorization bearer basic client_id client_secret session_id request response headers content_type
application/json text/html utf-8 https://www.example.com/index.html localhost:8080 /usr/local/bin/python
get_connection set_password create_session update_settings delete_record find_by_id to_string
getElementById addEventListener querySelectorAll applicationContext propertyPlaceholderConfigurer
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0000000000000000 1111111111111111
changeme example placeholder your_password_here your-api-key-here xxxxxxxxxxxxxxxxxxxx undefined null true false
def class return self.value = None if else for while in range(len(items)): function const let var public static void
"""

CANDIDATE_LEAST, NEAR, AROUND, NOVEL_SHARE, NOVEL_BYTES = 20, 48, 192, 0.6, 14
KINDS = ("assign", "access", "hex", "novel")
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long"


class Scanner:
    """Spans of secrets in a text."""

    def __init__(self, identifiers: str = IDENTIFIERS):
        import zstandard

        words = ("|".join(re.escape(w) for w in SENSITIVE))
        self.assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
        self.access = re.compile(ACCESS)
        self.hex = re.compile(HEX)
        self.near = re.compile(words, re.IGNORECASE | re.ASCII)
        self.run = re.compile(rf"[A-Za-z0-9+/_=.\-]{{{CANDIDATE_LEAST},}}")
        self.zstd = zstandard
        self.primed = identifiers.encode()

    def size(self, context: bytes, text: bytes) -> int:
        """Compressed bytes of text after the identifiers and the context."""
        d = self.zstd.ZstdCompressionDict(self.primed + context, dict_type=self.zstd.DICT_TYPE_RAWCONTENT)
        c = self.zstd.ZstdCompressor(level=3, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
        return len(c.compress(text))

    def novelty(self, text: str, start: int, end: int) -> int:
        """Marginal compressed bytes of a candidate against what stands around it, other candidates left out: a secret's copies don't excuse it."""
        before, after = self.run.sub(" ", text[max(0, start - AROUND) : start]), self.run.sub(" ", text[end : end + AROUND])
        context, tail = (before + after).encode(), before[-16:].encode()
        return self.size(context, tail + text[start:end].encode()) - self.size(context, tail)

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end), sorted; kind is a place in KINDS."""
        low = text.lower()
        sensitive = any(w in low for w in SENSITIVE)
        found = []
        if sensitive:
            found += [(m.start(), 0, m.end()) for m in self.assign.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
            found += [(m.start(), 1, m.end()) for m in self.access.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
        found += [(m.start(), 2, m.end()) for m in self.hex.finditer(text)]
        if sensitive:
            found += self.novel(text, found)
        return sorted(found)

    def novel(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Candidates that begin at most NEAR characters after a sensitive word or hold one."""
        words, out, w = [m.span() for m in self.near.finditer(text)], [], 0
        for m in self.run.finditer(text):
            a, b = m.span()
            while w + 1 < len(words) and words[w + 1][0] < b:
                w += 1
            if w >= len(words) or words[w][0] >= b or a - words[w][1] > NEAR:
                continue
            s = m[0]
            if not (any(c.isdigit() for c in s) and any(c.isalpha() for c in s)):
                continue
            if any(x < b and a < y for x, _, y in base):
                continue
            n = self.novelty(text, a, b)
            if n >= NOVEL_BYTES and n >= NOVEL_SHARE * (b - a):
                out.append((a, 3, b))
        return out


def digest_form(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame) -> DataFrame:
    """One row a document: numbers of spans by kind, the base spans' digest, and all spans."""

    def run(batches):
        import pyarrow as pa

        scanner = kept("secrets", Scanner)
        for batch in batches:
            rows = {k: [] for k in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel")}
            rows["doc_id"] = batch.column(0).to_pylist()
            for text in batch.column(1):
                spans = scanner.spans(text.as_py())
                base = [s for s in spans if s[1] < 3]
                for i, k in enumerate(("n_assign", "n_access", "n_hex", "n_novel")):
                    rows[k].append(sum(s[1] == i for s in spans))
                rows["base_sha256"].append(hashlib.sha256(digest_form(base).encode()).hexdigest())
                rows["spans"].append(digest_form(spans))
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([
                (k, pa.string() if k in ("base_sha256", "spans") else pa.int64()) for k in rows]))

    return texts(docs).mapInArrow(run, SCHEMA)


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """docs with each span of a secret replaced by the mask; n_chars, if there is one, follows the text."""
    columns, n_chars = small_batches(docs).columns, "n_chars" in docs.columns
    schema = docs.schema

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        scanner = kept("secrets", Scanner)
        for batch in batches:
            i, out = columns.index("text"), []
            for text in batch.column(i).to_pylist():
                if text:
                    pieces, at = [], 0
                    for a, _, b in scanner.spans(text):
                        if b > at:
                            pieces += [text[at:a], mask] if a >= at else []
                            at = b
                    text = "".join(pieces) + text[at:] if pieces else text
                out.append(text)
            new = pa.array(out, batch.schema.field(i).type)
            arrays = [new if k == i else batch.column(k) for k in range(len(columns))]
            if n_chars:
                j = columns.index("n_chars")
                changed = pc.not_equal(new, batch.column(i))
                arrays[j] = pc.if_else(changed, pc.utf8_length(new).cast(batch.schema.field(j).type), arrays[j])
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return docs.mapInArrow(run, schema)
