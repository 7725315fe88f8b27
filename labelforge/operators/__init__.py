"""DataFrame-in / DataFrame-out operators of the label-distillation workflow."""
