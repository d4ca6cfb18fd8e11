"""Adapters with stand-ins for the optional libraries, and files of many names."""

import sys
import types
import zipfile

import numpy as np
import pytest

from evalspark import adapters, cli
from evalspark.operators.summarize import OUT_OF_MEMORY, generate_all
from evalspark.sources import archives


@pytest.fixture
def library(monkeypatch):
    def install(name, **what):
        module = types.ModuleType(name)
        module.__spec__ = types.SimpleNamespace(name=name)
        module.__dict__.update(what)
        monkeypatch.setitem(sys.modules, name, module)
        return module

    return install


def test_pdf_library(library):
    class Page:
        def __init__(self, text):
            self.text = text

        def extract_text(self):
            if self.text == "broken":
                raise RuntimeError("no font")
            return self.text

    class PdfReader:
        def __init__(self, f):
            raw = f.read()
            if not raw.startswith(b"%PDF"):
                raise ValueError("no PDF")
            self.pages = [Page(x) for x in raw.decode().split("|")[1:]]

    library("pypdf", PdfReader=PdfReader)
    decoder = adapters.LibraryPdfDecoder()
    if decoder.library != "pypdf":
        pytest.skip("another PDF library is installed")
    assert decoder.decode(b"%PDF|one|two") == ("one\ntwo", True)
    assert decoder.decode(b"%PDF|one|broken|three") == ("one\nthree", False)
    assert decoder.decode(b"x") == ("", False) and decoder.decode(b"%PDF") == ("", False)


def test_without_a_pdf_library_the_simple_decoder_is_used(monkeypatch):
    monkeypatch.setattr(adapters.importlib.util, "find_spec", lambda name: None)
    with pytest.raises(ModuleNotFoundError):
        adapters.LibraryPdfDecoder()
    assert isinstance(cli._decoder(), archives.SimplePdfDecoder)


def test_encoder_is_loaded_once(library, monkeypatch):
    loads = []

    class SentenceTransformer:
        def __init__(self, name, device=None):
            loads.append((name, device))

        def encode(self, texts, batch_size, normalize_embeddings, show_progress_bar):
            return np.ones((len(texts), 3), np.float32)

    library("sentence_transformers", SentenceTransformer=SentenceTransformer)
    monkeypatch.setattr(adapters, "_loaded", {})
    args = cli.parser().parse_args(["classify", "--input", "x", "--model-name", "m", "--device", "cpu"])
    for _ in range(3):
        assert cli._encoder(args).encode(["a", "b"]).shape == (2, 3)
    assert loads == [("m", "cpu")]
    plain = cli.parser().parse_args(["full", "--input-folder", "x"])
    assert cli._encoder(plain).dim == 256 and cli._summarizer(plain) is None


def test_accelerator_out_of_memory_halves_the_batch():
    class Engine:
        sizes: list = []

        def generate(self, prompts):
            self.sizes.append(len(prompts))
            if len(prompts) > 1 or "huge" in prompts[0]:
                raise RuntimeError("CUDA out of memory. Tried to allocate 2 GiB")
            return ["ok"]

    assert generate_all(Engine(), ["a", "huge", "c"], 4) == ["ok", OUT_OF_MEMORY, "ok"] and Engine.sizes[0] == 3

    class Broken:
        def generate(self, prompts):
            raise RuntimeError("shape mismatch")

    with pytest.raises(RuntimeError, match="shape"):
        generate_all(Broken(), ["a"])


def test_many_files_of_one_name_get_a_name_each(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "LOG_PARTS", 4)
    for i in range(7):
        with zipfile.ZipFile(tmp_path / f"a{i}.zip", "w") as z:
            z.writestr("x/report_ESR.pdf", f"{i}")
            z.writestr("y/report_ESR.pdf", f"{i}")
            if i < 2:
                z.writestr("other_esr.pdf", "")
    entries = archives.expand_archives(archives.read_archives(spark, str(tmp_path)))
    log = archives.file_log(entries).collect()
    names = {f: sorted(r["stored_as"] for r in log if r["File"] == f) for f in ("report_ESR.pdf", "other_esr.pdf")}
    assert names["report_ESR.pdf"] == sorted(["report_ESR.pdf", *(f"report_ESR_{k}.pdf" for k in range(1, 14))])
    assert [r["stored_as"] for r in sorted((r for r in log if r["File"] == "other_esr.pdf"), key=lambda r: r["archive"])] == ["other_esr.pdf", "other_esr_1.pdf"]
