"""Layered (raw, silver, gold) batch data quality on Spark DataFrames."""

from sedimenta.config import PipelineConfig, layer_path
from sedimenta.session import build_session, recommended_conf

__all__ = ["PipelineConfig", "build_session", "layer_path", "recommended_conf"]
