from . import alignments, annotation, contigs, genes, pileup, reads, sources, variants  # noqa: F401
from .registry import REGISTRY

__all__ = ["REGISTRY"]
