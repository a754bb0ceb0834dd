"""Readers of frames, masks, arrays, mappings, text and audio."""
