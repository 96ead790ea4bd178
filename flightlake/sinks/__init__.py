"""Writers for layers and marts, month upserts, data dictionaries, size audit."""
