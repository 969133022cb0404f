"""Writers of the layers."""
