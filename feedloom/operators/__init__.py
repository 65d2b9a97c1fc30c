"""Distributed operators: normalise, de-duplicate, merge, lay out, audit."""
