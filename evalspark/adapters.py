"""Adapters around optional libraries: PDF texts, sentence vectors and generated summaries.

None of the libraries is needed to import this module. An adapter holds names
and options only, so that it can be sent to Python workers; each worker loads
the model once, however many tasks it runs.
"""

from __future__ import annotations

import importlib
import importlib.util
import io
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

#: Defaults of the encoder and of the generation.
EMBEDDING_MODEL, EMBEDDING_BATCH = "BAAI/bge-m3", 64
MAX_INPUT_TOKENS, MAX_NEW_TOKENS = 2048, 150

_loaded: dict[tuple, object] = {}


def once(key: tuple, load: Callable[[], object]) -> object:
    """What ``load`` returns, loaded at the first call for the key in this process."""
    if key not in _loaded:
        _loaded[key] = load()
    return _loaded[key]


def _library(names: list[str]) -> str:
    """The first of the libraries that is installed."""
    for name in names:
        if importlib.util.find_spec(name):
            return name
    raise ModuleNotFoundError(f"none of these libraries is installed: {', '.join(names)}")


class LibraryPdfDecoder:
    """The text of every page by pdfplumber or pypdf, whichever is installed.

    A page that can't be read is left out and the text counts as not wholly
    read; a file that is no PDF has no text.
    """

    def __init__(self) -> None:
        self.library = _library(["pdfplumber", "pypdf"])

    def decode(self, content: bytes) -> tuple[str, bool]:
        library = importlib.import_module(self.library)
        try:
            opened = library.open(io.BytesIO(content)) if self.library == "pdfplumber" else library.PdfReader(io.BytesIO(content))
            pages = [*opened.pages]
        except Exception:  # each library has errors of its own for files that are no PDF
            return "", False
        texts, ok = [], bool(pages)
        for page in pages:
            try:
                texts.append(page.extract_text() or "")
            except Exception:
                ok = False
        return "\n".join(texts), ok


@dataclass(frozen=True)
class ModelEncoder:
    """Vectors of a sentence-transformers model, of unit length."""

    name: str = EMBEDDING_MODEL
    device: str | None = None
    batch: int = EMBEDDING_BATCH

    def encode(self, texts: list[str]) -> np.ndarray:
        load = lambda: importlib.import_module("sentence_transformers").SentenceTransformer(self.name, device=self.device)
        model = once(("encoder", self.name, self.device), load)
        return np.asarray(model.encode(texts, batch_size=self.batch, normalize_embeddings=True, show_progress_bar=False), float)


@dataclass(frozen=True)
class ModelSummarizer:
    """Paragraphs of a causal language model by transformers, greedily; in 4 bits where a GPU is used, unless switched off."""

    name: str
    device: str | None = None
    max_new_tokens: int = MAX_NEW_TOKENS
    four_bit: bool = True

    def _load(self) -> tuple:
        t = importlib.import_module("transformers")
        tokenizer = t.AutoTokenizer.from_pretrained(self.name, padding_side="left")
        if tokenizer.pad_token is None:
            tokenizer.pad_token = tokenizer.eos_token
        options = {"quantization_config": t.BitsAndBytesConfig(load_in_4bit=True)} if self.four_bit and (self.device or "").startswith("cuda") else {}
        model = t.AutoModelForCausalLM.from_pretrained(self.name, **options)
        if self.device and not options:
            model = model.to(self.device)
        return tokenizer, model

    def generate(self, prompts: list[str]) -> list[str]:
        tokenizer, model = once(("summarizer", self.name, self.device, self.four_bit), self._load)
        if getattr(tokenizer, "chat_template", None):
            prompts = [tokenizer.apply_chat_template([{"role": "user", "content": p}], tokenize=False, add_generation_prompt=True) for p in prompts]
        inputs = tokenizer(prompts, return_tensors="pt", padding=True, truncation=True, max_length=MAX_INPUT_TOKENS).to(model.device)
        out = model.generate(**inputs, max_new_tokens=self.max_new_tokens, do_sample=False)
        width = inputs["input_ids"].shape[1]
        return [tokenizer.decode(row[width:], skip_special_tokens=True).strip() for row in out]
