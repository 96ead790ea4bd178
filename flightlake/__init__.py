"""Flight and population analytics expressed as Spark DataFrame plans.

Layers: ``sources`` read raw files and build flight-shaped inputs,
``functions`` hold column expressions, ``operators`` transform, validate,
enrich and aggregate, ``sinks`` write layers and marts, ``plans`` wire the
steps into a pipeline and the registered query set, ``streaming`` runs the
daily incremental load.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
