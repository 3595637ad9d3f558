"""Sources: texts, segment files, worker results, audio, configuration; and sinks."""
