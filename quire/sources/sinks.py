"""Sinks: manifests, CSV, joined text, HTML, EPUB, FB2, checksums, deterministic archives.

Rows are made by the engine. A single-file edition (TXT, HTML, EPUB, FB2, tar) is one book; its pages
are ordered by the engine and streamed to the driver page by page.
"""

from __future__ import annotations

import base64
import contextlib
import gzip
import io
import json
import os
import shutil
import tarfile
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPOCH = (1980, 1, 1, 0, 0, 0)


def manifest(header: dict, df: DataFrame, field: str = "records") -> str:
    """A header object with the rows in an array: UTF-8, two spaces, a final newline."""
    rows = [json.loads(r[0]) for r in df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).toLocalIterator()]
    return json.dumps(header | {field: rows}, ensure_ascii=False, indent=2) + "\n"


def flat_columns(df: DataFrame) -> DataFrame:
    """Arrays joined by semicolons, booleans as 0 or 1, for CSV."""
    kinds = dict(df.dtypes)
    one = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ";") if kinds[c].startswith("array") else F.col(c).cast("int") if kinds[c] == "boolean" else F.col(c)
    return df.select(*[one(c).alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str) -> None:
    """With a header of the columns; an empty table is written as a header only."""
    flat_columns(df).write.option("header", True).csv(path)


def joined_text(pages: DataFrame, order: str = "physical_index", text: str = "text", by: list[str] | None = None) -> DataFrame:
    """One text a book: pages in order, joined by a form feed between line feeds, with a final line feed."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(F.col(order), F.col(text)))), lambda x: x[text])
    return pages.groupBy(*(by or [])).agg(F.concat(F.array_join(ordered, "\n\f\n"), F.lit("\n")).alias("text"))


def sha256sums(files: DataFrame, itself: str = "SHA256SUMS") -> DataFrame:
    """(path, line) of all files but the list itself, sorted by path; files: path, content."""
    return files.where(F.col("path") != itself).select("path", F.concat(F.sha2("content", 256), F.lit("  "), F.col("path")).alias("line")).orderBy("path")


def _stored(archive: zipfile.ZipFile, name: str, data: bytes, kind: int = zipfile.ZIP_DEFLATED) -> None:
    info = zipfile.ZipInfo(name, EPOCH)
    info.compress_type, info.external_attr = kind, 0o644 << 16
    archive.writestr(info, data)


def markdown_report(title: str, counters: dict[str, DataFrame], ranked: DataFrame | None = None) -> str:
    """Counters (two columns each) and a ranked table; all are aggregates and small."""
    out = [f"# {title}", ""]
    for name, df in counters.items():
        out += [f"## {name}", "", *[f"- {r[0]}: {r[1]}" for r in df.collect()], ""]
    if ranked is not None:
        out += ["| " + " | ".join(ranked.columns) + " |", "|" + "---|" * len(ranked.columns)]
        out += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in ranked.collect()]
    return "\n".join(out).rstrip("\n") + "\n"


def html_edition(title: str, fragments: Iterable[str]) -> str:
    return f'<!DOCTYPE html>\n<html lang="ru"><head><meta charset="utf-8"><title>{escape(title)}</title></head><body>\n' + "\n".join(fragments) + "\n</body></html>\n"


def epub_edition(title: str, identifier: str, pages: Iterable[tuple[str, str]], images: dict[str, bytes]) -> bytes:
    """A reproducible EPUB 3: pages are (id, XHTML fragment); the mimetype comes first and is stored."""
    out = io.BytesIO()
    pages, title, identifier = list(pages), escape(title), escape(identifier)
    xhtml = lambda body, head="": f'<?xml version="1.0" encoding="utf-8"?>\n<html xmlns="http://www.w3.org/1999/xhtml" xmlns:epub="http://www.idpf.org/2007/ops"><head><title>{title}</title>{head}</head><body>{body}</body></html>'
    items = [f'<item id="nav" href="nav.xhtml" media-type="application/xhtml+xml" properties="nav"/>', *[f'<item id={quoteattr(f"p-{i}")} href={quoteattr(f"pages/{i}.xhtml")} media-type="application/xhtml+xml"/>' for i, _ in pages], *[f'<item id="i-{k}" href={quoteattr(name)} media-type="image/png"/>' for k, name in enumerate(sorted(images))]]
    opf = f'<?xml version="1.0" encoding="utf-8"?>\n<package xmlns="http://www.idpf.org/2007/opf" version="3.0" unique-identifier="id"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:identifier id="id">{identifier}</dc:identifier><dc:title>{title}</dc:title><dc:language>ru</dc:language></metadata><manifest>{"".join(items)}</manifest><spine>{"".join(f"<itemref idref={quoteattr(f'p-{i}')}/>" for i, _ in pages)}</spine></package>'
    links = "".join(f'<li><a href={quoteattr(f"pages/{i}.xhtml")}>{escape(i)}</a></li>' for i, _ in pages)
    with zipfile.ZipFile(out, "w") as z:
        _stored(z, "mimetype", b"application/epub+zip", zipfile.ZIP_STORED)
        _stored(z, "META-INF/container.xml", b'<?xml version="1.0"?>\n<container version="1.0" xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OEBPS/content.opf" media-type="application/oebps-package+xml"/></rootfiles></container>')
        _stored(z, "OEBPS/content.opf", opf.encode())
        _stored(z, "OEBPS/nav.xhtml", xhtml(f'<nav epub:type="toc"><ol>{links}</ol></nav><nav epub:type="page-list"><ol>{links}</ol></nav>').encode())
        for i, body in pages:
            _stored(z, f"OEBPS/pages/{i}.xhtml", xhtml(body).encode())
        for name in sorted(images):
            _stored(z, f"OEBPS/{name}", images[name])
    return out.getvalue()


def fb2_edition(title: str, pages: Iterable[tuple[str, list[str], list[str]]], images: dict[str, bytes]) -> bytes:
    """FictionBook 2: pages are (id, paragraphs, image names); binaries in base64."""
    ns, link = "http://www.gribuser.ru/xml/fictionbook/2.0", "http://www.w3.org/1999/xlink"
    ET.register_namespace("", ns)
    ET.register_namespace("l", link)
    root = ET.Element(f"{{{ns}}}FictionBook")
    info = ET.SubElement(ET.SubElement(root, f"{{{ns}}}description"), f"{{{ns}}}title-info")
    ET.SubElement(info, f"{{{ns}}}book-title").text = title
    body = ET.SubElement(root, f"{{{ns}}}body")
    for page, paragraphs, names in pages:
        section = ET.SubElement(body, f"{{{ns}}}section", {"id": page})
        for text in paragraphs:
            ET.SubElement(section, f"{{{ns}}}p").text = text
        for name in names:
            ET.SubElement(section, f"{{{ns}}}image", {f"{{{link}}}href": f"#{name}"})
    for name in sorted(images):
        ET.SubElement(root, f"{{{ns}}}binary", {"id": name, "content-type": "image/png"}).text = base64.b64encode(images[name]).decode()
    return ET.tostring(root, encoding="utf-8", xml_declaration=True)


def archive(files: Iterable[tuple[str, bytes]]) -> bytes:
    """A reproducible tar.gz: names sorted, no times, no owners."""
    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", mtime=0, filename="") as packed, tarfile.open(fileobj=packed, mode="w", format=tarfile.PAX_FORMAT) as tar:
        for name, data in sorted(files):
            info = tarfile.TarInfo(name)
            info.size, info.mode = len(data), 0o644
            tar.addfile(info, io.BytesIO(data))
    return out.getvalue()


def place_file(source: str, target: str) -> str:
    """Put a file at another place of a mounted folder by a hard link, else a copy, else a symbolic link; says which."""
    if not os.path.exists(source):
        raise FileNotFoundError(source)
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    with contextlib.suppress(FileNotFoundError):
        os.remove(target)
    for name, way in (("hardlink", os.link), ("copy", shutil.copy2), ("symlink", lambda a, b: os.symlink(os.path.abspath(a), b))):
        with contextlib.suppress(OSError):
            way(source, target)
            return name
    raise OSError(f"{source} cannot be placed at {target}")


def batch_archive(name: str, header: dict, records: DataFrame, files: Iterable[tuple[str, bytes]], note: str = "") -> bytes:
    """A batch for editors as one archive: its manifest, a note and its files, under a folder of its name."""
    head = [("manifest.json", manifest(header, records).encode()), *([("README.txt", note.encode())] if note else [])]
    return archive((f"{name}/{path}", data) for path, data in [*head, *files])


def epub_pages(data: bytes) -> Iterator[tuple[str, str]]:
    """(page id, text) of an EPUB's pages in the order of its spine."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        opf = ET.fromstring(z.read("OEBPS/content.opf"))
        ns = {"o": "http://www.idpf.org/2007/opf"}
        where = {i.get("id"): i.get("href") for i in opf.iterfind("o:manifest/o:item", ns)}
        for ref in opf.iterfind("o:spine/o:itemref", ns):
            page = ref.get("idref")
            yield page.removeprefix("p-"), " ".join(ET.fromstring(z.read(f"OEBPS/{where[page]}")).itertext())


def fb2_pages(data: bytes) -> Iterator[tuple[str, str]]:
    """(page id, text) of a FictionBook's sections, in order."""
    ns = "{http://www.gribuser.ru/xml/fictionbook/2.0}"
    for section in ET.fromstring(data).iter(f"{ns}section"):
        yield section.get("id"), "\n".join(p.text or "" for p in section.iter(f"{ns}p"))


def sealed(files: Iterable[tuple[str, bytes]], expected: dict[str, str]) -> list[str]:
    """Names whose SHA-256 differs from the one expected, or that are missing."""
    import hashlib

    found = {name: hashlib.sha256(data).hexdigest() for name, data in files}
    return sorted(n for n in expected if found.get(n) != expected[n])
