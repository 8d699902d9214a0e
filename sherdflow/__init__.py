"""Excavation reports to reviewed (artifact, image, description) pairs, as Spark plans."""

__version__ = "0.1.0"
