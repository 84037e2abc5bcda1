"""The modelled entities, composed from operators and rules."""
