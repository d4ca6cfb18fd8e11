"""Topic catalog and sentence encoders."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Topic names by block, which become columns of the block sheets. Their descriptions are our own.
TOPICS = {
    "C_Excellence": {
        "objectives_and_ambition": "objectives goals ambition targets measurable realistic beyond current work",
        "state_of_the_art": "state of the art literature prior work novelty progress existing solutions",
        "methodology": "methodology methods approach scientific procedure models assumptions",
        "design": "design study architecture structure sampling experimental setup",
        "validation": "validation testing verification evidence pilots demonstration metrics",
        "interdisciplinarity_and_gender": "interdisciplinary disciplines social sciences gender sex dimension",
        "open_science": "open science access data sharing reproducibility repositories",
        "engagement": "engagement citizens end users stakeholders co-creation involvement",
        "concepts_and_models": "concept conceptual model framework theory soundness",
        "resources": "resources tools facilities datasets inputs availability",
    },
    "C_Impact": {
        "pathways_to_impact": "pathway outcomes impacts expected logic work programme",
        "scale_and_significance": "scale significance magnitude quantified beneficiaries reach",
        "scientific_impact": "scientific impact knowledge community publications research",
        "economic_and_technological_impact": "economic technological market growth competitiveness jobs",
        "societal_and_environmental_impact": "societal environmental climate health wellbeing sustainability",
        "dissemination_plan": "dissemination plan conferences publications channels audience",
        "exploitation_strategy": "exploitation strategy business plan commercialisation results use",
        "intellectual_property_management": "intellectual property patents licences ownership protection",
        "communication_activities": "communication public media website campaigns outreach",
        "policy_and_standardization": "policy standards regulation standardisation bodies recommendations",
        "barriers_to_impact": "barriers obstacles risks uptake adoption mitigation",
    },
    "C_Implement": {
        "work_plan_structure": "work plan packages tasks timing dependencies structure",
        "resource_allocation": "resource allocation budget effort person months costs",
        "milestones_and_deliverables": "milestones deliverables deadlines verification schedule",
        "consortium_composition_and_synergy": "consortium composition complementarity partners synergy roles",
        "participant_capacity_and_expertise": "participant capacity expertise experience competence staff",
        "project_governance_and_management": "governance management decision coordination boards procedures",
        "risk_management_and_contingency": "risk contingency mitigation likelihood critical measures",
        "quality_assurance_and_monitoring": "quality assurance monitoring indicators review control",
        "data_and_infrastructure_management": "data management infrastructure storage platform access",
        "innovation_management": "innovation management ideas knowledge transfer process",
        "communication": "internal communication meetings exchange information flow",
        "dissemination": "dissemination tasks responsibilities work package",
        "exploitation": "exploitation tasks responsibilities work package",
        "subcontracting_and_third_parties": "subcontracting third parties subcontractors justification",
    },
}


class Encoder(Protocol):
    """Turns texts into vectors of one length. Instances are sent to the Python workers."""

    def encode(self, texts: list[str]) -> np.ndarray: ...


class HashingEncoder:
    """Signed hashed word counts, damped and of unit length: needs no model and no network."""

    def __init__(self, dim: int = 256) -> None:
        self.dim = dim

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim))
        for row, text in zip(out, texts, strict=True):
            for word in re.findall(r"\w+", text.lower()):
                h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
                row[(h >> 1) % self.dim] += 1 - 2 * (h & 1)
        out = np.sign(out) * np.log1p(np.abs(out))
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norm, out=np.zeros_like(out), where=norm > 0)


def encoded(df: DataFrame, text: str, encoder: Encoder, into: str = "vec") -> DataFrame:
    """Adds the vector of each text; batches span rows, and a null text is the empty text."""

    @F.pandas_udf("array<double>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(list(np.asarray(encoder.encode(texts.fillna("").tolist()), float)), index=texts.index)

    return df.withColumn(into, encode(F.col(text)))


def topic_catalog(spark: SparkSession, topics: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """(Block, topic_ord, topic, description), one row per topic."""
    rows = [(b, i, t, d) for b, own in (TOPICS if topics is None else topics).items() for i, (t, d) in enumerate(own.items())]
    return spark.createDataFrame(rows, "Block string, topic_ord int, topic string, description string")


def topic_index(catalog: DataFrame, encoder: Encoder) -> DataFrame:
    """(Block, topic_ord, topic, vec): the encoded catalog. Build it once and pass it on."""
    return encoded(catalog, "description", encoder).select("Block", "topic_ord", "topic", "vec")


def centroid_index(vectors: DataFrame, block: str, topic: str, vector: str) -> DataFrame:
    """A topic index whose vectors are the means of labelled example vectors."""
    parts = vectors.select(F.col(block).alias("Block"), F.col(topic).alias("topic"), F.posexplode(F.col(vector)).alias("i", "x"))
    means = parts.groupBy("Block", "topic", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    gathered = means.groupBy("Block", "topic").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("vec"))
    from pyspark.sql.window import Window

    order = F.row_number().over(Window.partitionBy("Block").orderBy("topic")) - 1
    return gathered.select("Block", order.alias("topic_ord"), F.col("topic").cast("string").alias("topic"), "vec")
