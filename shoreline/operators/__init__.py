"""DataFrame-to-DataFrame operators shared by the layer plans."""
