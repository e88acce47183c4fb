"""textlathe: labelled-text preparation on Spark (DataFrame in, DataFrame out)."""

from .functions.text import clean_text, clean_tokens, tokenize, vectorizer_tokens
from .operators.cleaning import process_data
from .operators.features import LIVE_CONFIG, TRAINING_CONFIG, FeatureConfig, FeatureModel, fit
from .operators.labels import apply_label_mapping, label_mapping
from .operators.quality import quality_report, validate
from .operators.split import SplitParams, split_data, stratified_folds, stratified_split
from .plans.prepare import features_for_splits, prepare
from .session import build_session

__all__ = [
    "clean_text", "clean_tokens", "tokenize", "vectorizer_tokens", "process_data",
    "FeatureConfig", "FeatureModel", "LIVE_CONFIG", "TRAINING_CONFIG", "fit",
    "label_mapping", "apply_label_mapping", "quality_report", "validate",
    "SplitParams", "split_data", "stratified_split", "stratified_folds",
    "features_for_splits", "prepare", "build_session",
]
