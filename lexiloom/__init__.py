"""Curation of labelled utterances (sentence, intent, typed entities) as Spark jobs."""

from lexiloom.config import Settings, Vocabulary, default_vocabulary, load_settings

__all__ = ["Settings", "Vocabulary", "default_vocabulary", "load_settings"]
