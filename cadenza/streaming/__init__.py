"""An extension: worker results as a stream."""
