"""Training-data operators: near-copy joins, decontamination, fingerprints,
classifiers, packing, line de-duplication and token counts.

Nothing outside this subpackage imports it.
"""
