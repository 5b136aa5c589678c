"""Spark-native catalogue and spectra analytics for mass-spectrometry repositories."""

__version__ = "0.1.0"
