"""Writers and keyed table updates."""
