"""Column-level functions (return ``Column`` expressions, JVM-side)."""

from quarry.functions.math import argmax, generation_score, prompt_half, sigmoid

__all__ = ["argmax", "generation_score", "prompt_half", "sigmoid"]
