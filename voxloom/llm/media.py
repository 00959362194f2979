"""Interleaved document sequences with media payloads that are resolved by digest.

HTML is parsed into an ordered array of items: texts and media references (src, caption). References of the form
sha256:<hex> are joined by digest with what a media store holds, and the items are put together again by
position (resolve_sequences), so that positions, captions and payloads stay aligned. The store keeps payloads as 8-bit mono WAV files;
its descriptions are computed from the stored bytes as they are read back.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import io
import wave
import zlib
from collections import Counter, deque
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

ITEM = "struct<pos:int,kind:string,text:string,src:string,caption:string>"
_ITEMS = pa.list_(pa.struct([("pos", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("src", pa.string()), ("caption", pa.string())]))
#: Elements whose text is not content, what a head holds (anything else ends it), elements that end a run of text, and those that refer to media.
SKIPPED = frozenset(("script", "style", "head", "nav", "template"))
HEAD = frozenset(("html", "head", "title", "base", "link", "meta", "script", "style", "noscript", "template"))
BLOCKS = frozenset(("p", "div", "article", "section", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "table", "tr", "td", "th", "br", "figure", "figcaption", "blockquote", "pre", "header", "footer"))
MEDIA = {"img": "image", "audio": "audio", "video": "video", "source": "media"}


class _Items(HTMLParser):
    """Items of a page. Elements whose places are in unclosed have no end tag: they are not skipped, and a caption among them ends at the next block."""

    def __init__(self, unclosed: frozenset):
        super().__init__(convert_charrefs=True)
        self.unclosed, self.found = unclosed, set()
        self.items, self.run, self.skip, self.figures, self.caption = [], [], [], [], None
        self.skipped: Counter = Counter()  # elements in skip, by name
        self.untaken, self.texts, self.captions = [], [], 0  # media without a figure's caption, captions without media (their places and texts), captions begun

    def parse_marked_section(self, i, report=1):
        """A marked section of an unknown kind is a comment, where the parser would give up."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i, report)

    def flush(self):
        if text := " ".join("".join(self.run).split()):
            self.items.append({"kind": "text", "text": text, "src": None, "caption": None})
        self.run = []

    def end_head(self):
        if self.skip and self.skip[-1][0] == "head":
            self.skip.pop()
            self.skipped["head"] -= 1

    def end_caption(self):
        self.caption = None

    def end_figure(self):
        """Give the caption of the innermost figure to its media, or make it a text where it stands."""
        self.end_caption()
        start, at, said = self.figures.pop()
        if said := " ".join("".join(said).split()):
            mine = []
            while self.untaken and self.untaken[-1] >= start:
                mine.append(self.untaken.pop())
            self.give(said, at, mine)

    def end_open_figures(self):
        """A figure without an end tag gives its caption to the media before it, or else to the next one. From the innermost out, each takes from what the inner ones left."""
        left: deque[int] = deque()
        while self.figures:
            start, at, said = self.figures.pop()
            while self.untaken and self.untaken[-1] >= start:
                left.appendleft(self.untaken.pop())
            if said := " ".join("".join(said).split()):
                mine = []
                while left and left[0] < at[0]:
                    mine.append(left.popleft())
                if left and not mine:
                    mine.append(left.popleft())
                self.give(said, at, mine)

    def give(self, said, at, media):
        for i in media:
            self.items[i]["caption"] = said
        if not media:
            self.texts.append((*at, said))

    def handle_starttag(self, tag, attrs):
        if tag not in HEAD:
            self.end_head()
        if (tag in SKIPPED or tag in ("title", "noscript") and self.skip) and self.getpos() not in self.unclosed:
            self.skip.append((tag, self.getpos()))
            self.skipped[tag] += 1
        if self.skip:
            return
        if tag in BLOCKS or tag in MEDIA:
            self.flush()
        if self.caption is not None and tag in BLOCKS:
            if tag in ("figure", "figcaption"):
                self.found.add(self.caption)
            if tag in ("figure", "figcaption") or self.caption in self.unclosed:
                self.end_caption()
            else:
                self.figures[-1][2].append(" ")
        if tag == "figure":
            self.figures.append([len(self.items), None, []])
        elif tag == "figcaption" and self.figures:
            figure = self.figures[-1]
            figure[2].append(" ")
            self.captions += 1
            if figure[1] is None:
                figure[1] = len(self.items), self.captions
            self.caption = self.getpos()
        elif tag in MEDIA and (src := dict(attrs).get("src")):
            self.untaken.append(len(self.items))
            self.items.append({"kind": MEDIA[tag], "text": None, "src": src, "caption": dict(attrs).get("alt")})

    def handle_startendtag(self, tag, attrs):
        if tag not in SKIPPED:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.skip:
            while self.skipped[tag]:
                name, place = self.skip.pop()
                self.skipped[name] -= 1
                if name == tag:
                    break
                self.found.add(place)
            return
        if tag in BLOCKS:
            self.flush()
        if tag == "figcaption":
            self.end_caption()
        elif self.caption is not None and tag in BLOCKS and tag != "figure":
            if self.caption in self.unclosed:
                self.end_caption()
            else:
                self.figures[-1][2].append(" ")
        if tag == "figure" and self.figures:
            self.end_figure()

    def handle_data(self, data):
        if data.strip():
            self.end_head()
        if not self.skip:
            (self.run if self.caption is None else self.figures[-1][2]).append(data)

    def end(self):
        self.close()
        self.flush()
        self.found |= {place for name, place in self.skip if name not in ("head", "script", "style")} | ({self.caption} - {None})
        self.end_open_figures()

    def ordered(self) -> list[dict]:
        """The items with captions that no media took where they stand, in the order in which they began."""
        out, at = [], 0
        for place, _, said in sorted(self.texts):
            out += self.items[at:place]
            out.append({"kind": "text", "text": said, "src": None, "caption": None})
            at = place
        return out + self.items[at:]


def parse_items(page: str | None) -> list[dict]:
    """Ordered items of one page; a null or empty page has none. Positions count from 0.

    A head ends where something stands that it can't hold. A caption ends with its figure; one that no media item takes is a
    text. Elements that are skipped, and captions in figures, are told from a first reading to have no end tag: what
    follows them is content. Only script and style last to the end of the page then, as HTML has it.
    """
    unclosed = frozenset()
    while True:
        parser = _Items(unclosed)
        parser.feed(page or "")
        parser.end()
        if parser.found <= unclosed:
            return [{"pos": i, **item} for i, item in enumerate(parser.ordered())]
        unclosed |= parser.found


def parse_sequences(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """One row per input row: id, items (array of pos, kind, text, src, caption)."""
    def kernel(batch):
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([parse_items(x) for x in batch.column(1).to_pylist()], _ITEMS)], ["id", "items"])

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).cast("string").alias("html"))
    return common.map_batches(src, kernel, f"id long, items array<{ITEM}>").withColumnRenamed("id", id_col)


def padded(text: bytes, unit: int = 64) -> bytes:
    """The text with bytes 0 up to a positive multiple of unit."""
    return text + bytes(max(1, -(-len(text) // unit)) * unit - len(text))


def to_wav(payload: bytes, rate: int = 8000) -> bytes:
    """Lossless: each byte is one unsigned 8-bit sample of a mono WAV file."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(stored: bytes) -> bytes:
    with wave.open(io.BytesIO(stored), "rb") as w:
        return w.readframes(w.getnframes())


def feature(payload: bytes) -> str:
    """Integer features of the samples: sum, sum of squares about 128, zero crossings, least, most."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64)
    y = x - 128
    return f"sum={x.sum()};energy={(y * y).sum()};crossings={np.count_nonzero((y[1:] >= 0) != (y[:-1] >= 0))};min={x.min()};max={x.max()}"


def store_media(df: DataFrame, text_col: str) -> DataFrame:
    """A store written in the shared folder: digest (sha256 of the padded payload), media (WAV).

    One row per input row, but for equal payloads in one batch, which are stored once. A null text is an empty payload.
    """

    def kernel(batch):
        seen = {}
        for text in common.utf8(batch.column(0)):
            payload = padded(text or b"")
            seen.setdefault(hashlib.sha256(payload).hexdigest(), payload)
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([to_wav(p) for p in seen.values()], pa.binary())], ["digest", "media"])

    return common.staged(common.map_batches(df.select(F.col(text_col).cast("string").alias("text")), kernel, "digest string, media binary"), "media")


def describe_media(store: DataFrame) -> DataFrame:
    """One row per digest, from the stored bytes as read back: payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature."""

    def kernel(batch):
        rows = [[] for _ in range(6)]
        for stored in batch.column(1).to_pylist():
            payload = from_wav(stored)
            for column, value in zip(rows, (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(payload))):
                column.append(value)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(rows, kinds))], ["digest", *DESCRIBED])

    each = common.map_batches(store.select("digest", "media"), kernel, "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
    return each.groupBy("digest").agg(*(F.first(c).alias(c) for c in DESCRIBED))


DESCRIBED = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]


def resolve(sequences: DataFrame, media: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """One row per item of the sequences, with the columns of media whose digest its src names (null if none does); a sequence without items has one row, whose pos is null.

    media has one row per digest. A digest that a third of all items name is one key of a shuffled join whose large
    partitions AQE splits; nothing is gathered by digest. Items keep pos and caption; resolve_sequences puts them together again.
    """
    items = sequences.select(F.col(id_col).alias("id"), F.explode_outer("items").alias("item")).select("id", "item.*", F.when(F.col("item.src").startswith("sha256:"), F.substring("item.src", 8, 64)).alias("digest"))
    return items.join(media.select("digest", *columns), "digest", "left").withColumnRenamed("id", id_col)


def resolve_sequences(sequences: DataFrame, media: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """One row per row of the sequences: id, items (array of pos, kind, text, src, caption, digest, columns) ordered by pos.

    Empty and null sequences have no items. Rows with equal or null ids stay sequences of their own. A sequence is
    gathered in one row, so its items with their columns have to fit there, as its page did.
    """
    keyed = sequences.select(F.struct(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row")).alias("key"), "items")
    item = F.when(F.col("pos").isNotNull(), F.struct("pos", "kind", "text", "src", "caption", "digest", *columns))
    out = resolve(keyed, media, "key", columns).groupBy("key").agg(F.sort_array(F.collect_list(item)).alias("items"))
    return out.select(F.col("key.id").alias(id_col), "items")


def as_page(caption: str, digest: str) -> str:
    """A page with one captioned audio reference."""
    return f'<article><p>{html_lib.escape(caption)}</p><figure><audio src="sha256:{digest}"></audio><figcaption>{html_lib.escape(caption)}</figcaption></figure></article>'


def document_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its whole text as a media payload, referred to from a page by digest and resolved from the store.

    One row per input row, repeated rows included: id, n_bytes (unpadded), the columns of describe_media. A null or empty
    text is 64 bytes 0. Equal texts have equal values in every column.
    """

    def kernel(batch):
        items = pa.array([parse_items(as_page(f"Document {name}", hashlib.sha256(padded(text or b"")).hexdigest())) for name, text in zip(batch.column(0).to_pylist(), common.utf8(batch.column(2)))], _ITEMS)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), items], ["id", "n_bytes", "items"])

    src = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).cast("string").alias("text"))
    sequences = common.map_batches(src, kernel, f"id long, n_bytes long, items array<{ITEM}>").select(F.struct("id", "n_bytes").alias("key"), "items")
    described = common.staged(describe_media(store_media(df, text_col)), "described")  # so that the join's own exchange can split a hot digest
    rows = resolve(sequences, described, "key", DESCRIBED).where("kind = 'audio'")
    return rows.select(F.col("key.id").alias(id_col), F.col("key.n_bytes").alias("n_bytes"), *DESCRIBED)


def page_media(df: DataFrame, store: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per page its sequence put together again, with what the store holds of the media that it names by digest: id, items.

    One row per input row; null, empty and broken pages have the items that they have. store as store_media gives it.
    """
    described = common.staged(describe_media(store), "described")
    return resolve_sequences(parse_sequences(df, id_col, html_col), described, id_col, DESCRIBED)
